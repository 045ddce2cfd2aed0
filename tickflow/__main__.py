from tickflow.cli import main

main()
