"""tradeledger: governed commerce analytics as plain PySpark DataFrame plans."""
