"""Entry file for ``spark-submit``; the steps are those of ``python -m churnlens``."""

import sys

from churnlens.__main__ import main

if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
