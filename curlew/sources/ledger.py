"""The acquisition ledger: insert or ignore under two unique keys.

Sequential inserts ignore a row whose normalised URL or hash was accepted before.
The same rows are found in parallel rounds: a row that comes first for both its keys
is accepted, a row that shares a key with an accepted earlier one is ignored, and
what is left goes into the next round. Most rows are decided in the first round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curlew.functions.urls import ledger_url
from curlew.session import materialize


def accepted(candidates: DataFrame, ledger: DataFrame | None = None, order: str = "arrival", url: str = "url", digest: str = "sha256") -> DataFrame:
    """The candidates that sequential insert-or-ignore in ``order`` (unique, ascending) keeps.

    A null URL or hash never collides. Rows of ``ledger`` (url, sha256) were accepted
    before all candidates.
    """
    open_ = candidates.withColumn("_u", ledger_url(url)).withColumn("_s", F.col(digest))
    if ledger is not None:
        for key, known in (("_u", ledger.select(ledger_url(url).alias("_u"))), ("_s", ledger.select(F.col(digest).alias("_s")))):
            open_ = open_.join(known.where(F.col(key).isNotNull()).distinct(), key, "left_anti")
    open_ = materialize(open_.select(*candidates.columns, "_u", "_s"), "open")
    done = []
    while not open_.isEmpty():
        firsts = [open_.where(F.col(k).isNotNull()).groupBy(k).agg(F.min(order).alias(f"_f{k}")) for k in ("_u", "_s")]
        seen = open_
        for k, first in zip(("_u", "_s"), firsts):
            seen = seen.join(first, k, "left")
        own = F.lit(True)
        for k in ("_u", "_s"):
            own = own & (F.col(k).isNull() | (F.col(f"_f{k}") == F.col(order)))
        took = materialize(seen.where(own).select(*candidates.columns, "_u", "_s"), "took")
        done.append(took.select(*candidates.columns))
        rest = open_.join(took.select(F.col(order)), order, "left_anti")
        for k in ("_u", "_s"):
            rest = rest.join(took.select(k).where(F.col(k).isNotNull()).distinct(), k, "left_anti")
        open_ = materialize(rest.select(*candidates.columns, "_u", "_s"), "open")
    if not done:
        return candidates.limit(0)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out
