"""Text normalisation with pandas string semantics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import NULL_TOKENS

# Runs of cased letters alternate with runs of everything else.
_CASED_RUNS = r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"
# What str.strip() removes; Spark's own trim only knows the blank.
WHITE_SPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE_SPACE))


def title_case(c: Column) -> Column:
    """Upper-case the first letter of every letter run: ``o'brien`` -> ``O'Brien``.

    ``initcap`` only looks at blanks, so it would leave ``O'brien``.
    """
    runs = F.regexp_extract_all(F.lower(c), F.lit(_CASED_RUNS), F.lit(1))
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, 2, 1 << 30))), ""
    )


def null_tokens_to_null(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Read the usual empty markers in every text column as null."""
    text = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    return df.select(
        *[F.when(~F.col(c).isin(*tokens), F.col(c)).alias(c) if c in text else F.col(c) for c in df.columns]
    )


def text_or_default(df: DataFrame, name: str, default: str) -> Column:
    """The stripped text of a column; its default when null or when the column is absent."""
    if name not in df.columns:
        return F.lit(default)
    return strip(F.coalesce(F.col(name).cast("string"), F.lit(default)))


def level_filter(line: Column, levels: Sequence[str]) -> Column:
    """True when the line contains any of the level names."""
    found = F.lit(False)
    for level in levels:
        found = found | line.contains(level)
    return found
