"""spark-submit entry point for the daily refresh (see setbook/plans/daily.py).

    spark-submit --py-files setbook.zip daily_job.py --cells CELLS --journal JOURNAL --marts MARTS
"""

from setbook.plans.daily import main

if __name__ == "__main__":
    main()
