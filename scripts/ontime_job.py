"""Driver script for spark-submit: ``spark-submit --py-files ontime.zip scripts/ontime_job.py <command> ...``."""

from ontime.cli import main

if __name__ == "__main__":
    main()
