from pawprint.cli import main

main()
