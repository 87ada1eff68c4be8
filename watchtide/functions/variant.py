"""Typed reads from semi-structured values.

Reads are declared as data (``Read``) so a job can place them right above the table scan. There Spark turns each
path into a column of the shredded Parquet variant, and only the members that are used are read and shuffled.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from watchtide.functions.text import text


NUMBER_KINDS = "^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)"


class Read(NamedTuple):
    """One typed member of a variant column: output name, source column, path below it, SQL type."""

    name: str
    root: str
    path: str
    kind: str = "string"

    def column(self, root: Column | None = None) -> Column:
        source = F.col(self.root) if root is None else root
        return member(source, self.path, self.kind).alias(self.name)


def member(value: Column, path: str, kind: str = "string") -> Column:
    """Typed member at ``path``; wrong kinds read as null, and a missing string as ``""``."""
    found = F.try_variant_get(value, "$" + path, kind)
    return text(found) if kind == "string" else found


def nullable_text(value: Column, path: str) -> Column:
    """String member that stays null when missing."""
    return F.try_variant_get(value, "$" + path, "string")


def part(value: Column, path: str) -> Column:
    """Sub-value at ``path`` as a variant; null only when the member is absent."""
    return F.try_variant_get(value, "$" + path, "variant")


def is_object(value: Column, path: str = "") -> Column:
    """True for a JSON object at ``path``. Reading any other kind as a struct gives null, and nothing is copied."""
    return F.try_variant_get(value, "$" + path, "struct<id:variant>").isNotNull()


def is_number(value: Column) -> Column:
    """True for a JSON number: text and booleans that could be cast to one do not count."""
    return F.coalesce(F.rlike(F.schema_of_variant(value), F.lit(NUMBER_KINDS)), F.lit(False))


def is_string(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def has_content(value: Column) -> Column:
    """False for an absent, null, empty or zero value, true for anything else."""
    return value.isNotNull() & ~F.to_json(value).isin("null", "{}", "[]", '""', "0", "0.0", "false")


def canonical_json(value: Column) -> Column:
    """Compact JSON text with sorted keys at every level; non-ASCII text stays as it is."""
    return F.to_json(value)


def with_reads(df: DataFrame, reads) -> DataFrame:
    """Adds the declared reads that ``df`` does not already carry."""
    missing = [r for r in reads if r.name not in df.columns]
    return df.withColumns({r.name: member(F.col(r.root), r.path, r.kind) for r in missing}) if missing else df
