from pricelens.cli import main

main()
