"""Entry script of the daily job for spark-submit; see tallyshelf.plans.daily_job."""

from tallyshelf.plans.daily_job import main

if __name__ == "__main__":
    main()
