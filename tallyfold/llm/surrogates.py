"""Replaces personal data in all texts by keyed surrogates.

1. Every text is searched; the distinct entities of the corpus become one table.
2. Each entity draws a surrogate of its type and format from a keyed stream. The draw is refused if another entity
   drew the same, or if it is itself an entity of the corpus, and the entity draws again. So different entities stay
   different, no surrogate points at somebody real, and an entity has one surrogate wherever it occurs.
3. Texts that hold entities are joined with the surrogates of their own entities and rewritten. All other texts pass
   through without being moved.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.arrow import by_batch
from tallyfold.llm.entities import Entity, find, surrogate, written
from tallyfold.session import stage

_ENTITY = ["kind", "scope", "norm"]
_FOUND = pa.list_(pa.struct([(n, pa.string()) for n in _ENTITY]))


def _mark(docs: DataFrame, text: str, identity: str) -> Column:
    """Key of a text: rows that share it get the surrogates of each other's entities too, which changes nothing."""
    return F.xxhash64(F.col(identity), F.col(text))


def mentions(docs: DataFrame, identity: str, text: str) -> DataFrame:
    """(mark, kind, scope, norm): the distinct entities of each text."""

    def work(batch: pa.RecordBatch) -> dict:
        found = [sorted({s.entity for s in find(t.as_py())}) for t in batch.column(1)]
        return {"mark": batch.column(0), "found": pa.array([[e._asdict() for e in f] for f in found], _FOUND)}

    marked = docs.select(_mark(docs, text, identity).alias("mark"), F.col(text).alias("text"))
    listed = by_batch(marked, work, "mark long, found array<struct<kind:string,scope:string,norm:string>>")
    return listed.select("mark", F.inline("found")).distinct()


def _drawn(entities: DataFrame, key: bytes) -> DataFrame:
    """Adds `value`, the surrogate of the row's attempt."""

    def work(batch: pa.RecordBatch) -> dict:
        rows = batch.to_pylist()
        values = [surrogate(Entity(r["kind"], r["scope"], r["norm"]), r["attempt"], key) for r in rows]
        return {**{c: batch.column(c) for c in [*_ENTITY, "attempt"]}, "value": values}

    return by_batch(
        entities.select(*_ENTITY, "attempt"), work, "kind string, scope string, norm string, attempt int, value string"
    )


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, scope, norm, value) for distinct entities; values differ from each other and from all entities.

    Rounds end when nothing is refused. Each holds only what the round before refused, and after some attempts
    surrogates grow: a small range (one letter, a short address form, a private network) widens, so the rounds end
    whatever the corpus holds.
    """
    names = entities.select("kind", "scope", F.col("norm").alias("value"))
    left = entities.withColumn("attempt", F.lit(0))
    done = None
    while True:
        drawn = stage(_drawn(left, key), "drawn")
        taken = names if done is None else names.unionByName(done.select("kind", "scope", "value"))
        free = drawn.join(taken, ["kind", "scope", "value"], "left_anti")
        # Of those that drew the same, the least entity keeps it.
        first = free.groupBy("kind", "scope", "value").agg(F.min("norm").alias("norm"))
        kept = stage(first.select(*_ENTITY, "value"), "surrogates")
        done = kept if done is None else done.unionByName(kept)
        left = drawn.join(kept, _ENTITY, "left_anti").select(*_ENTITY, (F.col("attempt") + 1).alias("attempt"))
        if left.isEmpty():
            return done
        left = stage(left, "refused")


_SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"


def replace(docs: DataFrame, key: bytes, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, text, spans) for every row of `docs`, `row` being all its columns as a struct.

    `text` is the rewritten text. `spans` lists what was replaced: kind, place in the old text (code points) and what
    stands there now. A null text stays null, a text without entities stays as it is. Repeated rows and equal ids are
    rows of their own. The same key gives the same result. No rows give no rows.
    """
    listed = stage(mentions(docs, identity, text), "mentions")
    values = assign(stage(listed.select(*_ENTITY).distinct(), "entities"), key)
    known = listed.join(values, _ENTITY).groupBy("mark").agg(F.collect_list(F.struct(*_ENTITY, "value")).alias("known"))

    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"), _mark(docs, text, identity).alias("mark"))
    kind = docs.schema.simpleString()

    def sort(batch: pa.RecordBatch) -> dict:
        names = [batch.column(c) for c in ("row", "text", "mark")]
        return {**dict(zip(("row", "text", "mark"), names)), "any": [bool(find(t.as_py())) for t in batch.column(1)]}

    sorted_rows = by_batch(rows, sort, f"row {kind}, text string, mark long, any boolean")
    untouched = sorted_rows.where("not any").select("row", "text", F.array().cast(_SPANS).alias("spans"))
    touched = sorted_rows.where("any").drop("any").join(known, "mark").select("row", "text", "known")

    def work(batch: pa.RecordBatch) -> dict:
        texts, spans = [], []
        for old, known in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            values = {Entity(k["kind"], k["scope"], k["norm"]): k["value"] for k in known}
            parts, listed, at = [], [], 0
            for s in find(old):
                new = written(old[s.start : s.end], s.entity, values[s.entity])
                parts += [old[at : s.start], new]
                listed.append({"kind": s.entity.kind, "start": s.start, "end": s.end, "value": new})
                at = s.end
            texts.append("".join(parts) + old[at:])
            spans.append(listed)
        return {"row": batch.column(0), "text": texts, "spans": spans}

    return untouched.unionByName(by_batch(touched, work, f"row {kind}, text string, spans {_SPANS}"))


def replaced_rows(docs: DataFrame, key: bytes, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with rewritten texts; a length column `n_chars` follows the text."""
    done = replace(docs, key, identity, text)

    def column(name: str) -> Column:
        if name == text:
            return F.col("text").alias(name)
        if name == "n_chars":
            return F.length("text").cast(docs.schema[name].dataType).alias(name)
        return F.col(f"row.`{name}`").alias(name)

    return done.select(*[column(n) for n in docs.columns])
