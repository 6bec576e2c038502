from collections import Counter

import corpus_pipeline
from churnlake.llm.decontamination import decontaminate
from churnlake.llm.mixing import mix_documents
from churnlake.llm.simhash import deduplicate
from churnlake.llm.toxicity import drop_toxic, train
from .test_decontamination import plain as plain_hits
from .test_mixing import plain_mix
from .test_sharding import jump
from .test_simhash import closure, plain_fingerprint

SMALL = "/root/testdata/sf0.001"


def test_every_stage_against_a_plain_version(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    kept = {"start": docs}
    for name, stage in stages.items():
        stage(spark, kept[list(kept)[-1]], SMALL).write.parquet(str(tmp_path / name))
        kept[name] = spark.read.parquet(str(tmp_path / name))
        if name != "sharding":
            assert kept[name].columns == docs.columns
    rows = {k: [(r["doc_id"], r["text"], r["source"]) for r in df.collect()] for k, df in kept.items() if k != "sharding"}
    chain = train(docs, labels)
    assert sorted(r[0] for r in rows["toxicity"]) == sorted(i for i, t, _ in rows["start"] if chain.score(t or "")[-1] < 0.5)
    fps = {i: plain_fingerprint(t) for i, t, _ in rows["toxicity"]}
    comp = closure([(a, b) for a in set(fps.values()) for b in set(fps.values()) if a < b and (a ^ b).bit_count() <= 3], set(fps.values()))
    first = {}
    for i in sorted(fps):
        first.setdefault(comp[fps[i]], i)
    assert sorted(r[0] for r in rows["near_dedup"]) == sorted(first.values())
    assert sorted(r[0] for r in rows["decontamination"]) == sorted(i for i, t, _ in rows["near_dedup"] if not plain_hits(t, items)[1])
    copies = Counter()
    for (i, size, words), n in plain_mix(rows["decontamination"], True).items():
        copies[i] += n * (words // size if size else 0)
    assert Counter(r[0] for r in rows["mixing"]) == +copies
    last = kept["sharding"].collect()
    assert Counter(r["doc_id"] for r in last) == +copies and all(r["shard"] == jump(r["doc_id"], 40) for r in last)


def test_columns_of_any_name_pass_through(spark):
    names = ["__p", "p", "__id", "__h", "__src", "__no", "__text", "__take", "__at", "at", "no", "take", "takes", "key_id", "key_h", "key_src",
             "group", "fp", "comp", "cut", "spans", "c_0", "c_1", "bad_id", "mixed", "copy"]
    texts = [f"one{i} two{i} three{i} four{i} five{i} six{i}" for i in range(6)] + [None, "", "same words stand here twice", "same words stand here twice"]
    rows = [(i, t, "s", *[f"{n}-{i}" for n in names]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in names))
    labels = spark.createDataFrame([(0, 0), (1, 0)], "doc_id long, toxic long")
    benchmark = spark.createDataFrame([("b", "nothing of these texts")], "item_id string, text string")
    for out in (drop_toxic(docs, labels), deduplicate(docs), mix_documents(docs), decontaminate(docs, benchmark)):
        assert out.columns == docs.columns
        got = out.collect()
        assert got and all(r[n] == f"{n}-{r['doc_id']}" for r in got for n in names)
