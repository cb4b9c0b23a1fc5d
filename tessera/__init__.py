"""tessera: cell-table ETL and change tracking as Spark DataFrame plans.

Every operator is a function over DataFrames (plus the caller's
SparkSession where files or tables are touched). Nothing here holds global
state; nothing routes data through the driver.

Modules:
    sources      CSV / Parquet / JSON / multi-path reads, SQL text, named queries
    sinks        files, managed and external tables, inserts, views
    functions    scalar column functions (Java string hash, salted keys, JVM trim, dates)
    operators    cells (the mutation log), convert, cas, lookup, match, index, clean, setops, partitions
    plans        ETL, change tracking, enrichment round trips
    streaming    Structured Streaming forms of the store operators
    catalog      registered queries with their DuckDB oracle SQL
"""

__version__ = "0.1.0"
