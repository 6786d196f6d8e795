"""Launcher for spark-submit:

    spark-submit --py-files ratebook.zip submit.py common --quotes ... (see ratebook/cli.py)
"""

import sys

from ratebook.cli import main

if __name__ == "__main__":
    main(sys.argv[1:])
