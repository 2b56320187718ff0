import hashlib

import corpus_pipeline


def test_last_stage_decodes_its_ids(spark):
    rows = [(1, "né  à\n", "x"), (2, "", "y"), (3, "日本 \U0001f600\x00", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded string")
    got = {r.doc_id: r for r in corpus_pipeline.encode_pieces(spark, df, "").collect()}
    for k, text, other in rows:
        assert got[k].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert got[k].n_tokens == len(got[k].ids) and got[k].decoded == other and got[k].text == text
