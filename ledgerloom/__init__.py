"""Analytics over public ledger exports, written as ordinary PySpark DataFrame plans."""
