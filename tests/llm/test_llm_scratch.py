"""Working tables go as soon as what was made from them is written."""

from pathlib import Path

import pytest
from conftest import multiset

from eventlake.llm.components import components
from eventlake.llm.minhash import similar_documents, without_near_duplicates
from eventlake.llm.paragraphs import without_repeats
from eventlake.llm.passages import without_passages
from eventlake.llm.tables import alone, scratch, written
from eventlake.session import checkpoint_dir
from eventlake.sources.paths import exists

LINE = "one two three four five six seven eight nine ten eleven twelve"
PASSAGE = " ".join(f"word{i}" for i in range(30))


@pytest.fixture
def left(spark):
    """Names of the working tables that are there now and were not before."""
    base = Path(checkpoint_dir(spark).removeprefix("file:")) / "eventlake"
    names = lambda: {p.name.rpartition("-")[0] + p.name[-8:] for p in base.glob("*")}
    before = names()
    return lambda: {name[:-8] for name in names() - before}


@pytest.fixture
def docs(spark):
    texts = [f"{LINE}\nalone {i}\n{LINE} thirteen\nin {i} {PASSAGE}" for i in range(6)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)


def test_only_the_result_is_left(spark, left):
    rows = spark.range(5)
    with scratch() as made:
        result = alone(lambda: written(written(rows, "first").where("id > 1"), "second"))
    assert left() == {"second"} and multiset(result) == multiset(rows.where("id > 1"))
    assert len(made) == 1 and exists(spark, made[0])  # whoever tidies up outside knows of it


def test_rounds_of_components_go(spark, left):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    found = components(links, "rounds")
    assert left() == {"rounds"} and {(r.node, r.root) for r in found.collect()} == {(i, 0) for i in range(41)}


@pytest.mark.parametrize(
    ("operator", "stay"),
    [
        (without_repeats, {"removals"}),
        (without_passages, {"passages"}),
        (similar_documents, {"signatures", "components", "classes", "lowest", "component-of"}),
        (without_near_duplicates, {"signatures", "components", "first-of-key", "first-of-component", "kept", "removed", "repeated"}),
    ],
)
def test_operators_leave_what_they_read(docs, left, operator, stay):
    result = operator(docs)
    assert result.count() > 0 and left() <= stay
