from loomwick.llm import quality_rules as op

SCHEMA = "doc_id long, text string, lang string, source string"


def text(k, n_symbols):
    return " ".join(f"w{(k * 7 + j * j) % 97}{j}x" + ("*" if j < n_symbols else "") for j in range(60))


def test_groups_get_limits_of_their_own(spark):
    plain = [(k, text(k, 0), "en", "plain") for k in range(120)] + [(900, text(900, 15), "en", "plain")]
    marked = [(1000 + k, text(k, 8 + k % 9), "en", "marked") for k in range(120)] + [(1900, text(900, 15), "en", "marked")]
    df = spark.createDataFrame(plain + marked, SCHEMA)
    limits = {r.source: r.max_symbol_share for r in op.thresholds(op.measure(df)).collect()}
    assert limits["plain"] < limits["marked"] and limits["plain"] == 20
    kept = {r.doc_id: r.kept for r in op.judge(df).collect()}
    assert not kept[900] and kept[1900]  # the same text
    assert all(v for k, v in kept.items() if k != 900)


def test_small_groups_take_those_of_language_and_of_all(spark):
    rows = [(k, text(k, 6 + k % 3), "de", "large") for k in range(120)] + [(500, text(5, 0), "de", "small"), (501, text(6, 0), None, None)]
    limits = {(r.lang, r.source): r.max_symbol_share for r in op.thresholds(op.measure(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert len(limits) == 3 and limits["de", "small"] == limits["de", "large"] == limits[None, None] > 20
