"""Named query plans over the driver test tables (see SURVEY section 7.4).

``catalog.QUERIES`` maps a query name to ``fn(spark, sf_dir) -> DataFrame``;
``oracle.ORACLE_SQL`` holds the equivalent DuckDB SQL for each name.
"""
