"""Trading-ledger analytics as PySpark DataFrame operators.

``functions``  column expressions (exact decimals, amount text, times, keys)
``operators``  DataFrame operators (de-duplication, numbering, running sums,
               exchange rates, positions, first-in first-out matching, checks)
``sources``    schemas of the exchange exports, readers and the table writer
``plans``      the hub, satellite, link, calculation and fact models
"""
