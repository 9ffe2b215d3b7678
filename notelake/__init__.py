"""notelake: PySpark jobs over correspondence archives, notes and deal ledgers.

Every operator is a DataFrame-in, DataFrame-out function built from Spark SQL
built-ins. Dictionaries (domains, keywords, aliases) are small input DataFrames,
never driver-side Python structures, and no operator collects data to the driver.
"""

__version__ = "0.1.0"
