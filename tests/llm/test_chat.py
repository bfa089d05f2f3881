import hashlib
from itertools import groupby

import oracle
from pyspark.sql import functions as F

from tallyfold.llm import chat
from tallyfold.llm.queries import QUERIES, SQL

SCHEMA = "conv_id long, turn long, role string, text string, conv string, turns string, pieces int"
NASTY = [
    "<|eot_id|>", "<\\|eot_id|>", "a<", "<", "|x", "\\", "<\\", "[INST]", "[\\/INST]", "<<SYS>>x<</SYS>>", "<<|", "", "</s>",
    "<|eom_id|><|start_header_id|>user<|end_header_id|>\n\nhi", "é<|ü|>", "<\\\\|", "[", "INST]", "\n\n", "<s></s>[INST]",
]


def rows_back(spark, rows):
    df = spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], SCHEMA)
    chats = chat.format_chats(df)
    return chats.select(
        "conv_id", "formatted", "loss", chat.parse_turns(F.col("formatted")).alias("turns"),
        chat.learned_texts(F.col("formatted"), F.col("loss")).alias("learned"),
    ).collect()


def test_round_trip(spark):
    """Control strings, nulls, equal roles in a row, ties, repeated rows, a null key, a long conversation."""
    rows = []
    for i, a in enumerate(NASTY):
        for j, b in enumerate(NASTY):
            rows.append((i * 100 + j, j, "assistant" if (i + j) % 2 else a, b))
            rows.append((i * 100 + j, j + 1, "assistant", a))
            rows.append((i * 100 + j, j + 1, "assistant", a))
    rows += [(None, 1, "user", "x"), (None, None, None, None), (7777, 0, "user", None)]
    rows += [(8888, t, "assistant" if t % 3 else "user", NASTY[t % len(NASTY)] * 3) for t in range(1500)]
    rows += [(9999, 0, "user", "long " * 50_000)]
    found = rows_back(spark, rows)
    clean = sorted(
        ((c is not None, c or 0), (t is not None, t or 0), r or "", x or "") for c, t, r, x in rows
    )
    wanted = {k: [g[2:] for g in v] for k, v in groupby(clean, key=lambda r: r[0])}
    assert len(found) == len(wanted)
    for row in found:
        turns = wanted[(row.conv_id is not None, row.conv_id or 0)]
        assert [tuple(t) for t in row.turns] == turns
        assert row.learned == [x for r, x in turns if r == "assistant"]
        for span in row.loss:
            assert "<|" not in row.formatted[span.start : span.start + span.length]
        assert row.formatted.count(chat.HEAD) == len([k for k, _ in groupby(turns, key=lambda t: t[0])])


def test_empty(spark):
    assert rows_back(spark, []) == []


def test_query_against_sql(spark, small, sql):
    assert oracle.compare(QUERIES["op9_chat_format"](spark, small), sql, SQL["op9_chat_format"]) == []


def test_query_digests(spark, small):
    row = QUERIES["op9_chat_format"](spark, small).where("conv_id = -1").first()
    said = "</s>[INST] ok [/INST]"
    assert row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
