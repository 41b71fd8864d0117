"""DuckDB SQL re-derivations of every registered query (the correctness oracle).

Written independently of the Spark code: plain windows over each whole file,
SQL list lambdas for images, so a mistake in the Spark carry or expression
helpers shows up as a mismatch.
"""
