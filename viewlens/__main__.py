from viewlens.cli import main

main()
