"""``python -m cctally <job> --config run.json --as-of YYYY-MM-DD``."""

import sys

from .plans.cli import main

main(sys.argv[1:])
