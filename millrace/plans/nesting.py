"""Queries over nested and repeated fields."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import nested as N
from millrace.plans.registry import query


@query("nested_project", """
SELECT doc_id, type, no_repo AS is_null, CASE WHEN NOT no_repo THEN r_url END AS r_url,
       CASE WHEN NOT no_repo THEN r_created_at END AS r_created_at FROM repositories
""", uses=("repositories",))
def _(t):
    kept = N.project_nested(t.view("repositories"), "repository", ["url", "created_at"], ["doc_id", "type"])
    return kept.select(
        "doc_id",
        "type",
        F.col("repository").isNull().alias("is_null"),
        F.col("repository.url").alias("r_url"),
        F.col("repository.created_at").alias("r_created_at"),
    )


@query("nested_with_field", """
SELECT doc_id, r_url, lower(r_description) AS r_description, r_forks FROM repositories
WHERE url IS NOT NULL AND NOT no_repo AND r_description IS NOT NULL
""", uses=("repositories",))
def _(t):
    required = ["url", "repository", "repository.description"]
    lowered = N.lower_nested_field(t.view("repositories"), "repository", "description", required)
    return lowered.select(
        "doc_id",
        F.col("repository.url").alias("r_url"),
        F.col("repository.description").alias("r_description"),
        F.col("repository.forks").alias("r_forks"),
    )


@query("repeated_filter", """
SELECT ngram, coalesce(string_agg(CAST(year AS VARCHAR), ',' ORDER BY pos) FILTER (year >= 1900), '') AS years,
       coalesce(string_agg(CAST(year AS VARCHAR), ',' ORDER BY pos) FILTER (year > 1950), '') AS recent
FROM ngrams GROUP BY ngram
""", uses=("ngrams",))
def _(t):
    kept = N.repeated_years(t.view("ngrams"), "cell", 1900)
    kept = N.repeated_years(kept, "cell", 1950, "recent", strict=True)
    return kept.select(
        "ngram",
        F.array_join(F.col("years").cast("array<string>"), ",").alias("years"),
        F.array_join(F.col("recent").cast("array<string>"), ",").alias("recent"),
    )


@query("repeated_rewrite", r"""
SELECT ngram, string_agg(regexp_replace(value, '[\[\]]', '', 'g') || '=' || volume_count, ';' ORDER BY pos) AS cells
FROM ngrams WHERE volume_count > 3 GROUP BY ngram
""", uses=("ngrams",))
def _(t):
    rewritten = N.rewrite_cells(t.view("ngrams"), "cell")
    rendered = F.transform("cell", lambda c: F.concat(c["value"], F.lit("="), c["volume_count"]))
    return rewritten.select("ngram", F.array_join(rendered, ";").alias("cells"))
