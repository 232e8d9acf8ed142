from railyard.cli import main

main()
