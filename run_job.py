"""Launcher of the batch jobs: spark-submit run_job.py JOB ... (or python run_job.py JOB ...)."""

from scoreloom.plans.jobs import main

if __name__ == "__main__":
    main()
