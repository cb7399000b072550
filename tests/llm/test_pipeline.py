"""The pipeline's stages on a small table, each held against plain code."""

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from harvestry.llm import mixing, quality
from tests.llm.test_line_dedup import plain
from tests.llm.test_ngram_join import plain_components
from tests.llm.test_packing import check

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, []
    for place, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if place < 4:
            assert after.columns == columns
        seen.append((docs, after))
        docs = after

    def rows(df):
        return sorted((r["doc_id"], r["text"]) for r in df.collect())

    before, good = seen[0]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    score = quality.scored(before, quality.train(before, labels))
    assert rows(good) == rows(score.where("score >= 0.5"))
    assert 0.5 * before.count() < good.count() < before.count()
    lined = rows(seen[1][1])
    want = plain([t for _, t in rows(good)], 10)
    assert lined == [(i, t) for (i, _), (t, *_) in zip(rows(good), want, strict=True)]
    kept = rows(seen[2][1])
    classes = plain_components(lined, 5, 80)
    assert [i for i, _ in kept] == sorted(i for i, n, c in classes if i == c)
    assert set(kept) <= set(lined)
    words = {}
    for i, t in rows(seen[3][1]):
        words[i] = words.get(i, 0) + len(t.split())
    assert words == {r["doc_id"]: r["taken"] for r in mixing.taken(seen[2][1]).collect()
                     if r["taken"]}
    packed = seen[4][1].collect()
    check(packed, 1024)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = sum(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1
              for _, t in rows(seen[3][1]))
    assert sum(r["length"] for r in packed) == ids


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id",
                           "offset"] and out.count()
