"""The engine's functions for SQL users, as SQL functions of their session.

Masks, bands and dependency names are SQL all through, so a query that calls them is planned as if their text
stood in it; the entropy is the one Arrow function.
"""

from pyspark.sql import SparkSession

from patchlens.functions.entropy import register_sql_functions
from patchlens.lookups import (
    HIGH_RISK_THRESHOLD,
    JAVASCRIPT_DEPENDENCY,
    LEAK_THRESHOLD,
    PACKAGING_TOOLS,
    PYTHON_DEPENDENCY,
)

_TOOLS = ", ".join(f"'{tool}'" for tool in PACKAGING_TOOLS)

#: Name, parameters, result and body of each function.
FUNCTIONS = (
    ("mask_segments", "c STRING", "STRING", r"regexp_replace(c, r'([^/]{3})[^/]+', r'$1***')"),
    ("mask_sha", "c STRING", "STRING", "concat(substring(c, 1, 8), repeat('*', 16))"),
    (
        "mask_repo",
        "c STRING, segment INT, whole INT",
        "STRING",
        "CASE WHEN contains(c, '/') THEN concat(substring(split_part(c, '/', 1), 1, segment), '**/', "
        "substring(split_part(c, '/', 2), 1, segment), '**') ELSE concat(substring(c, 1, whole), '**') END",
    ),
    (
        "risk_band",
        "score DOUBLE",
        "STRING",
        f"CASE WHEN score > {LEAK_THRESHOLD} THEN 'CRITICAL' WHEN score > {HIGH_RISK_THRESHOLD} THEN 'HIGH' ELSE 'LOW' END",
    ),
    (
        "manifest_kind",
        "filename STRING",
        "STRING",
        "CASE WHEN contains(lower(filename), 'requirements.txt') THEN 'Python' "
        "WHEN contains(lower(filename), 'package.json') THEN 'JavaScript' END",
    ),
    (
        "dependencies",
        "filename STRING, patch STRING",
        "ARRAY<STRUCT<library_name: STRING, language: STRING>>",
        "CASE WHEN contains(lower(filename), 'requirements.txt') THEN transform(filter("
        f"transform(regexp_extract_all(patch, r'{PYTHON_DEPENDENCY}', 1), name -> lower(name)), name -> name NOT IN ({_TOOLS})), "
        "name -> named_struct('library_name', name, 'language', 'Python')) "
        "WHEN contains(lower(filename), 'package.json') THEN transform("
        f"regexp_extract_all(patch, r'{JAVASCRIPT_DEPENDENCY}', 1), "
        "name -> named_struct('library_name', lower(name), 'language', 'JavaScript')) END",
    ),
)


def register_functions(spark: SparkSession) -> None:
    """Make ``shannon_entropy(text)`` and ``FUNCTIONS`` known to the session's SQL.

    ``dependencies(filename, patch)`` is an array, and gives rows by ``FROM (SELECT *, dependencies(filename, patch) AS
    found FROM files) LATERAL VIEW inline(found) added``. As a SQL table function it would be planned as a
    join of the files with themselves, on their whole patches.
    """
    register_sql_functions(spark)
    for name, parameters, result, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
