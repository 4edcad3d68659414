"""Launcher for spark-submit (which runs a file, not a module):

    zip -r paperweave.zip paperweave
    spark-submit --py-files paperweave.zip run_job.py --raw <snapshot-root> --out <dir>
"""

from paperweave.plans.job import main

if __name__ == "__main__":
    main()
