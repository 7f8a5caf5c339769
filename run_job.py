"""spark-submit launcher: ``spark-submit --py-files perkflow.zip run_job.py <command> ...``."""

import sys

from perkflow.cli import main

if __name__ == "__main__":
    sys.exit(main())
