"""ledgerlens: operating-expense ledger analytics on Spark DataFrames."""
