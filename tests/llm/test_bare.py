"""Tables in which an operator finds nothing to do: no text, short texts, nothing shared, one row, no ids."""

import pytest

from brindle.llm import decontam, ngramjoin, pieces, queries, shards, sketch, suffix, toxicity
from brindle.llm.shared import shared_folder

SCHEMA = "doc_id long, text string"
APART = " ".join(chr(33 + (k * 7 + k * k) % 90) for k in range(300))
TABLES = {
    "null": [(1, None), (2, None)],
    "short": [(1, "a"), (2, "b"), (3, "")],
    "apart": [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, APART)],
    "one": [(7, "a single document that has no other beside it, but more than fifty bytes of text")],
    "no id": [(None, "the first of two rows that have no id, which is long enough to be compared"), (None, "another text, also without any id, which the first has not a thing to do with")],
}


@pytest.mark.parametrize("name", TABLES)
def test_nothing_to_do(spark, name):
    rows = TABLES[name]
    docs = spark.createDataFrame(rows, SCHEMA)
    size = sorted(len((t or "").encode()) for _, t in rows)

    found = suffix.repeats(docs).collect()
    assert sorted(r.n_bytes for r in found) == sorted(len(r.kept) for r in found) == size and not any(r.spans for r in found)
    assert sorted(map(repr, (tuple(r) for r in suffix.remove_repeats(docs).collect()))) == sorted(repr((i, t or "")) for i, t in rows)  # a null text is empty

    classes = ngramjoin.join(docs).collect()
    assert len(classes) == len(rows)
    assert sorted(r.n_links for r in classes) == ([1, 1] if name == "null" else [0] * len(rows))

    benchmark = spark.createDataFrame([], "item_id string, text string")
    assert [r.n_hit for r in decontam.scan(docs, benchmark).collect()] == [0] * len(rows)
    assert decontam.decontaminate(docs, benchmark).count() == len(rows)

    assert shards.assign(docs, 8).count() == len(rows)
    assert sketch.against_next(docs).count() == len(rows)
    vocabulary = pieces.load(queries.PIECES)
    assert sorted((r.decoded or "") for r in pieces.decode(pieces.encode(docs, vocabulary), vocabulary).collect()) == sorted((t or "") for _, t in rows)


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)], [(1, 1, 0), (2, 0, 0)], [(99, 1, 1)]])
def test_toxicity_with_hardly_a_label(spark, labels):
    docs = spark.createDataFrame(TABLES["apart"], SCHEMA)
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs, model).collect())


@pytest.mark.parametrize("case", ["null", "apart", "one"])
def test_warc_of_few_pages(spark, case):
    from brindle.llm import warc

    rows = [(k, None if case == "null" else f"http://x.org/{k}", t) for k, (_, t) in enumerate(TABLES[case])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = f"{shared_folder(spark)}/few-{case}"
    warc.write(pages, folder)
    warc.index(warc.read(spark, folder, payloads=False), f"{folder}-index")
    found = warc.fetch_all(warc.captures(pages.select("page_id", "url"), f"{folder}-index"), folder).collect()
    assert sorted((r.page_id, r.payload_bytes) for r in found) == [(k, len((t or "").encode())) for k, _, t in rows]
