"""The pipeline on planted rows, stage by stage."""

import numpy as np

import corpus_pipeline
from tests.llm.helpers import DOCS, docs
from voltide.llm.bpe import ByteBpe, loaded

COMMON = ["the", "of", "and", "to", "in", "a", "is", "that"]


def natural(n, seed):
    """Text with the common words a language has and own words else."""
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        if rng.random() < 0.3:
            out.append(COMMON[min(int(rng.exponential(2.5)), 7)])
        else:
            out.append("".join(rng.choice(list("etaoinshrdlu"), rng.integers(3, 9))))
    return " ".join(out) + "."


def planted():
    passage = natural(70, 999)
    rows = [(k, natural(120, k)) for k in range(1, 15)]
    changed = rows[4][1].split()
    changed[60] = "other"
    rows += [(20, rows[3][1]), (21, " ".join(changed))]
    rows += [(30, natural(80, 30) + "\n" + passage), (31, natural(90, 31) + "\n" + passage)]
    rows += [(40, " ".join(w + "###" for w in natural(100, 40).split())), (41, "too short"), (42, None)]
    return rows


def test_stages_take_effect_and_keep_clean_documents(spark, tmp_path):
    df = docs(spark, planted())
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, df, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        df = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert df.columns == [c.split()[0] for c in DOCS.split(", ")]
        kept[name] = {r["doc_id"]: r for r in df.collect()}
    clean = {*range(1, 15), 30, 31}
    assert set(kept["quality rules"]) == clean | {20, 21}
    assert set(kept["SimHash near-dedup"]) == clean
    cut = kept["substring dedup"]
    assert set(cut) == clean
    texts = dict(planted())
    assert {i for i in clean if cut[i]["text"] != texts[i]} == {31}
    assert cut[31]["text"] == natural(90, 31) and cut[31]["n_chars"] == len(cut[31]["text"])
    path = __import__("public_tokenizers").path("byte_bpe_50k.json")
    want = sum(len(i) + 1 for i in loaded(ByteBpe, path).ids_of([r["text"] for r in cut.values()]))
    assert sum(r["length"] for r in df.collect()) == want


def test_run_equals_the_stages_and_empty_input(spark, tmp_path):
    docs(spark, planted()).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in got} == {*range(1, 15), 30, 31}
    empty = tmp_path / "none"
    docs(spark, []).write.parquet(f"{empty}/documents.parquet")
    assert corpus_pipeline.run(spark, str(empty)).collect() == []


def test_stages_are_named():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "SimHash near-dedup", "substring dedup", "best-fit packing",
    ]
