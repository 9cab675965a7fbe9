"""spark-submit entry point for the scheduled loads; see ``ledgerloom.plans.cli``."""

import logging
import sys

from ledgerloom.plans import cli, jobs

if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    try:
        cli.main(sys.argv[1:])
    except jobs.NoInputError as e:
        logging.error("%s", e)
        sys.exit(2)
