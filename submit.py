"""Script for ``spark-submit``; see ``tripmart.jobs`` for the arguments."""

from tripmart.jobs import main

if __name__ == "__main__":
    main()
