"""Entry point for spark-submit: ``spark-submit --py-files trailmill.zip run_job.py session …``."""

from trailmill.plans.jobs import main

if __name__ == "__main__":
    main()
