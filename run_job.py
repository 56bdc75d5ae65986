"""spark-submit entry: ``spark-submit --py-files cctally.zip run_job.py <job> --config run.json --as-of YYYY-MM-DD``."""

import sys

from cctally.plans.cli import main

if __name__ == "__main__":
    main(sys.argv[1:])
