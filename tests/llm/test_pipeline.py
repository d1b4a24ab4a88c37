import os
import random
import subprocess
import sys

import pytest

import corpus_pipeline
from quillspark.llm import simhash
from quillspark.llm.common import written
from quillspark.llm.queries import ORACLES, QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
ITEM = "What the seven rivers carry to the sea in spring is mostly silt and broken ice from the hills"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Documents of every kind that a stage has to decide on."""
    rng = random.Random(11)
    path = str(tmp_path_factory.mktemp("corpus"))
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8)))
    plain = lambda n=80: " ".join(word() for _ in range(n))
    rows = [(i, plain()) for i in range(60)]
    rows += [(100 + i, f"{plain(20)} idiot {plain(20)} scum {plain(5)}") for i in range(20)]
    rows += [(200 + i, f"{plain(40)}\nShared Footer \n{plain(30)}") for i in range(12)]
    copy = plain(100)
    rows += [(300, copy), (301, copy.upper()), (302, copy.replace(" ", "  ")), (302, copy.replace(" ", "  "))]
    rows += [(400, f"{plain(30)} {ITEM} {plain(30)}"), (401, f"{plain(30)}\n{ITEM.replace('silt', 'slit').upper()}")]
    rows += [(None, plain()), (500, None), (501, "")]
    docs = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(100 <= i < 200)) for i, _ in rows if i is not None and i < 250]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_each_stage_decides(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = written(stage(spark, docs, sf_dir), "test-stage")
        seen[name] = before, docs
        if name != "sentencepiece":
            assert docs.columns == columns and docs.schema["text"].dataType.simpleString() == "string"
    ids = {name: sorted(r.doc_id for r in after.collect() if r.doc_id is not None) for name, (_, after) in seen.items()}
    given = sorted(r.doc_id for r in seen["toxicity"][0].collect() if r.doc_id is not None)
    assert ids["toxicity"] == [i for i in given if not 100 <= i < 200]
    assert ids["line_dedup"] == ids["toxicity"]
    after = {r.doc_id: r for r in seen["line_dedup"][1].collect()}
    for r in seen["line_dedup"][0].collect():
        lines = (r.text or "").split("\n")
        # The footer stays in the first of its documents.
        want = "\n".join(x for x in lines if x.strip().lower() != "shared footer" or r.doc_id == 200)
        assert after[r.doc_id].text == want and after[r.doc_id].n_chars == len(want)
    # Near copies against all pairs of fingerprints.
    rows = [(r.doc_id, simhash.fingerprint(r.text)) for r in seen["simhash_near_dedup"][0].collect() if r.doc_id is not None]
    group = {i: {j for j, g in rows if bin(f ^ g).count("1") <= 4} for i, f in rows}
    assert ids["simhash_near_dedup"] == sorted({min(g) for g in group.values()})
    assert {300, 500} <= set(ids["simhash_near_dedup"]) and not {301, 302, 501} & set(ids["simhash_near_dedup"])
    assert ids["decontamination"] == [i for i in ids["simhash_near_dedup"] if i not in (400, 401)]
    assert ids["sentencepiece"] == ids["decontamination"]
    assert all(r.round_trip and r.n_ids == len(r.ids) for r in docs.collect())
    assert [r for r in docs.collect() if r.doc_id is None]


def test_run_gives_the_last_stage(spark, sf_dir):
    assert {"ids", "doc_id"} <= set(corpus_pipeline.run(spark, sf_dir).columns)


def test_registered_and_optional():
    import __spark_entry__ as entry

    assert QUERIES.keys() | {"pipeline"} <= entry.queries().keys() and ORACLES.keys() <= entry.oracle_sql().keys()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    blocked = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('quillspark.llm', 'corpus_pipeline'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not any(n.startswith('op') and n[2].isdigit() or n == 'pipeline' for n in e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", blocked], check=True, cwd=ROOT, timeout=120)
