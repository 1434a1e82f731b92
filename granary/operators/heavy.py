"""Joins to sources that repeat a key heavily."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.functions import named
from granary.operators.cleaning import evaluate_once

_SALT = "_salt"
_CONTENT = "_content"


def join_heavy(base: DataFrame, source: DataFrame, on: Sequence[str], spread: int | None = None) -> DataFrame:
    """Left join to a source that is read and shuffled once, whatever its keys' frequencies.

    Rows of the source are dealt by key and a salt from their content, so a key is split
    over up to ``spread`` tasks (by default the session's shuffle partitions). Which salts
    a key has is counted where its rows lie; a row of ``base`` is sent to these alone. So a rare
    key costs as many copies as it has rows, a heavy one ``spread``, and nothing is left
    to be balanced at run time. Copies of one row share a salt: repeated rows should be few.

    Null keys match nothing. A base row without match appears once, with nulls.
    """
    keys = list(on)
    others = [name for name in source.columns if name not in keys]
    spread = spread or int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = reduce(lambda a, b: a & b, [named(name).isNotNull() for name in keys])
    salt = F.coalesce(F.pmod(F.xxhash64(*map(named, source.columns)), F.lit(spread)).cast("int"), F.lit(0))
    dealt = source.filter(known).withColumn(_SALT, salt).repartition(*map(named, keys), named(_SALT))
    # The hash of whole rows tells matched keys from others, and makes counting salts and joining
    # ask for the same columns: both then read one exchange, and the source is scanned once.
    content = F.max(F.xxhash64(*map(named, source.columns))).alias(_CONTENT)
    salts = dealt.groupBy(*map(named, keys), named(_SALT)).agg(content)
    asked = evaluate_once(base.join(salts, keys, "left"))
    columns = [*base.columns, *others]
    matched = asked.filter(named(_CONTENT).isNotNull()).join(dealt, [*keys, _SALT]).select(*map(named, columns))
    alone = asked.filter(named(_CONTENT).isNull()).select(*map(named, base.columns))
    return matched.unionByName(alone, allowMissingColumns=True)
