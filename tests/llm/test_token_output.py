import struct
import zlib

from loomwick.llm import token_output as op
from loomwick.llm.common import scratch

ROWS = [
    (3, "The cat's 42nd hat…  \n\n  sat,\tdown 12½ naïve ßtraße"),
    (1, None),
    (2, ""),
    (7, "日本語 text <|endoftext|> and ᲀ more"),
    (5, "word " * 5000),
    (5, "same id, other text"),
    (6, "   \x1c\x85 odd spaces here'll don't 'S"),
]


def expected(rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(op.default_tokenizer())
    out, start = [], 0
    for i, text in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def written(spark, rows, schema="doc_id long, text string"):
    path = scratch(spark, "test")
    op.write_tokens(spark.createDataFrame(rows, schema), path, op.default_tokenizer())
    return op.read_tokens(spark, path)


def test_equals_the_library(spark):
    got = [tuple(r) for r in op.digest(written(spark, ROWS)).orderBy("start").collect()]
    same_id = [r for r in ROWS if r[0] == 5]
    orders = [sorted([r for r in ROWS if r[0] != 5] + same_id[::k], key=lambda r: r[0]) for k in (1, -1)]
    assert got in [expected(o) for o in orders]


def test_empty_table_and_clashing_columns(spark):
    assert op.digest(written(spark, [])).collect() == []
    df = spark.createDataFrame([(1, "a b", 9, 8)], "doc_id long, text string, part int, tie int")
    path = scratch(spark, "test")
    op.write_tokens(df, path, op.default_tokenizer())
    assert op.read_tokens(spark, path).count() == 1


def test_metadata_reads_skip_the_ids(spark):
    plan = written(spark, ROWS).select("doc_id", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[-1]
