"""Analytics over long-read transcriptome tables as PySpark DataFrames."""
