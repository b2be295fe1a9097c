"""spark-submit entry point for the batch job.

    zip -r casaflow.zip casaflow
    spark-submit --py-files casaflow.zip casaflow_submit.py \
        --raw s3://bucket/raw --store s3://bucket/warehouse [--cleaned ...] \
        [--lake ...] [--feeds ...] [--jdbc-url ... --jdbc-password-env VAR]
"""

from casaflow.plans.orchestrate import main

if __name__ == "__main__":
    print(main())
