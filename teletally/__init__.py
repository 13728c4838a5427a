"""Viewing-log analytics on Spark DataFrames.

Grains used throughout, from fine to coarse:

* log row          contract, app_name, duration, log_date (+ any caller columns)
* session          log row with its category
* daily total      contract, category, log_date, total
* total            contract, category, total
* daily pivot      contract, log_date, one duration column per category
* pivot / profile  contract, one duration column per category (+ metrics)
"""
