"""spark-submit entry point of the batch job; see tillspark/plans/job.py."""

import sys

from tillspark.plans.job import main

if __name__ == "__main__":
    sys.exit(main())
