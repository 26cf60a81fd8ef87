import re
from collections import Counter

import pytest
from .test_line_dedup import plain as plain_lines
from .test_near_dedup import plain as plain_groups
from .test_packing import whole_ids

import __spark_entry__ as entry
import corpus_pipeline
from costledger.llm import mixing, queries, toxicity
from costledger.llm.common import crc_remainder

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_registered():
    found = entry.queries()
    assert "pipeline" in found and {f"op{n}" for n in range(1, 11)} <= {name.split("_")[0] for name in found}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "packing"]
    assert set(queries.QUERIES) <= set(found)


def test_equals_a_plain_version(spark, sf):
    """Each stage against a plain version of its rule over what the stage before has written."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").where(crc_remainder("doc_id", 5) != 0)
    scorer = toxicity.Scorer(toxicity.learn(docs, labels))
    rows = {r["doc_id"]: r for r in docs.collect()}
    texts = {i: r["text"] for i, r in rows.items()}
    grammar = scorer.grammar
    score = lambda t: 1 / (1 + 2.718281828459045 ** -(scorer.weights[0] + sum(w * f for w, f in zip(scorer.weights[1:], grammar.features(t), strict=True))))
    texts = {i: t for i, t in texts.items() if score(t) < 0.5}
    texts = {d[0]: kept if dropped else d[1] for d, (_, dropped, kept) in plain_lines(list(texts.items()), 10).items()}
    texts = {i: texts[i] for i, (_, smallest) in plain_groups(list(texts.items()), 5).items() if smallest == i}
    frame = spark.createDataFrame([(i, t, rows[i]["source"]) for i, t in texts.items()], "doc_id long, text string, source string")
    repeats = {r["doc_id"]: r["repeats"] for r in mixing.mix(frame).collect()}
    want = Counter({i: n * len(whole_ids(texts[i])) for i, n in repeats.items() if n})
    got = Counter()
    for r in corpus_pipeline.run(spark, sf).collect():
        got[r["doc_id"]] += r["length"]
    assert got == want


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_the_columns_and_take_odd_rows(spark, sf, stage):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, "x " * 50_000, "en", "a", 100_000), (3, "same text of five words here", None, "b", 1), (3, "same text of five words here", None, "b", 1)]
    rows += [(10 + i, f"the repeated line\nown words {i} {i + 1} {i + 2} {i + 3}", "en", "c", 40) for i in range(12)]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], COLUMNS + ", score int, size int, rep long")
    found = stage[1](spark, docs, sf)
    assert found.dtypes == docs.dtypes
    ids = Counter(r["doc_id"] for r in found.collect())
    if stage[0] in ("toxicity", "line_dedup"):
        assert ids == Counter(r[0] for r in rows)
    if stage[0] == "near_dedup":
        assert ids == Counter({r[0] for r in rows})
    assert stage[1](spark, docs.limit(0), sf).count() == 0


def test_nothing_else_imports_the_subpackage():
    import pathlib

    root = pathlib.Path(entry.__file__).parent
    for path in [*root.glob("costledger/**/*.py"), *root.glob("*.py"), *root.glob("tests/*.py")]:
        if "llm" not in path.parts and path.name not in ("__spark_entry__.py", "corpus_pipeline.py"):
            assert not re.search(r"costledger\.llm|from costledger import llm|corpus_pipeline", path.read_text()), path
