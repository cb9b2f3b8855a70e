import random

import corpus_pipeline
from shruti.llm import surrogates
from shruti.llm.queries import pii_key, queries

from . import test_decontamination as decontamination
from . import test_near_copies as near_copies
from . import test_packing as packing
from . import test_quality as quality


def corpus(tmp_path, spark):
    """A folder of tables with everything that the stages look for."""
    docs, labels = quality.corpus(spark, 300, 7)
    r = random.Random(3)
    rows = [(x.doc_id, x.text) for x in docs.collect()]
    good = [x for x in rows if len(x[1].split()) > 100 and "%" not in x[1]]
    n = len(rows)
    for k in range(40):  # exact and near copies
        words = r.choice(good)[1].split()
        if k % 2:
            words[r.randrange(len(words))] = "changed"
        rows.append((n + k, " ".join(words)))
    items = [(i, " ".join(f"bench{i}{c}" for c in "abcdefghijklmnopq")) for i in range(5)]
    rows += [(n + 100 + i, f"{t} {r.choice(good)[1][:60]}") for i, t in items]
    rows += [(n + 200 + i, f"{r.choice(good)[1][::-1]} mail bob{i}.fry@corp.org or +1 (415) 555-01{i:02d} today") for i in range(20)]
    rows += [(n + 300, ""), (n + 301, None), (n + 302, "x " * 20000)]
    r.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", spark.createDataFrame(items, "item_id long, text string"))):
        df.repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path), items


def test_stages_against_plain_versions(spark, tmp_path):
    sf_dir, items = corpus(tmp_path, spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "decontamination", "pii", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        out.write.parquet(f"{tmp_path}/stage-{name}")
        docs = spark.read.parquet(f"{tmp_path}/stage-{name}")
        kept[name] = (before, docs.collect())
    before, after = kept["quality"]
    scores = {r.doc_id: r.predicted for r in queries()["op8_quality"](spark, sf_dir).collect()}
    assert sorted(r.doc_id for r in after) == sorted(i for i, p in scores.items() if p) and len(after) < len(before)
    before, after = kept["near_copies"]
    components = {c for i, n, c in near_copies.by_force([(r.doc_id, r.text) for r in before], 5, 80) if n}
    blank = [r.doc_id for r in before if not (r.text or "").split()]
    assert sorted(r.doc_id for r in after) == sorted([*components, *blank]) and len(after) < len(before)
    before, after = kept["decontamination"]
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if not decontamination.by_force(r.text, items)[4]) and len(after) < len(before)
    before, after = kept["pii"]
    z, old = surrogates.Surrogates(pii_key(spark)), {r.doc_id: r.text for r in before}
    assert {r.doc_id: r.text for r in after} == {i: z.replace(t)[0] if t else t for i, t in old.items()}
    changed = [r for r in after if r.text != old[r.doc_id]]
    assert changed and all("@corp.org" not in r.text and "555-01" not in r.text for r in changed)
    last = [(r.doc_id, r.text) for r in docs.collect()]
    packing.check(last, corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect(), 2048)


def test_run_is_the_stages_one_after_another(spark, tmp_path):
    sf_dir, _ = corpus(tmp_path, spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got, want = (sorted(map(tuple, df.select(*columns).collect()), key=repr) for df in (corpus_pipeline.run(spark, sf_dir), docs))
    assert got == want and got
