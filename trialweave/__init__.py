"""trialweave: weave clinical-trial registers into one table and answer questions over it.

``functions``  Column -> Column expressions
``operators``  DataFrame -> DataFrame building blocks, column names as arguments
``sources``    landing, parsing and writing of raw records
``plans``      whole jobs over the trial schema
"""
