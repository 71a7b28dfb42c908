"""Entry script for spark-submit."""

from skytally.cli import main

if __name__ == "__main__":
    main()
