import public_tokenizers
import tiktoken

import corpus_pipeline
from adloom.llm import byte_bpe, personal_data, quality_rules, simhash
from adloom.llm.common import table
from test_near_copies import brute_groups
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"


def test_stages_against_plain_python(spark):
    """Each stage on its own input; then run() against the stages."""
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5 and corpus_pipeline.ORACLE_SQL is None

    verdicts = {r.doc_id: r for r in quality_rules.measure(docs).collect()}
    good = stages["quality_rules"](spark, docs, FOLDER).cache()
    assert good.columns == columns
    assert {r.doc_id: r.text for r in good.collect()} == {i: r.clean_text for i, r in verdicts.items() if r.kept}

    rows = sorted(good.collect(), key=lambda r: r.doc_id)
    first = {}
    for r, group in zip(rows, brute_groups([r.text for r in rows]), strict=True):
        first.setdefault(group, r.doc_id)
    single = stages["simhash_near_copies"](spark, good, FOLDER).cache()
    assert single.columns == columns
    assert sorted(r.doc_id for r in single.collect()) == sorted(first.values())

    safe = stages["personal_data"](spark, single, FOLDER).cache()
    assert safe.columns == columns and safe.count() == single.count()
    assert not any(personal_data.base_spans(r.text) for r in safe.collect())

    mixed = stages["source_mixing"](spark, safe, FOLDER).cache()
    assert mixed.columns == columns
    times, sizes = {}, {}
    for r in mixed.collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    assert max(times.values()) <= 3
    all_words = sum(len(r.text.split()) for r in safe.collect())
    assert abs(sum(sizes.values()) - all_words) < 0.3 * all_words

    encoding = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=byte_bpe.read_ranks(public_tokenizers.path(corpus_pipeline.RANKS)),
        special_tokens={},
    )
    want = sorted((r.doc_id, encoding.encode_ordinary(r.text)) for r in mixed.collect())
    assert sorted((r.doc_id, r.ids) for r in stages["byte_level_bpe"](spark, mixed, FOLDER).collect()) == want
    assert sorted((r.doc_id, r.ids) for r in corpus_pipeline.run(spark, FOLDER).collect()) == want


def test_stages_with_odd_rows_and_clashing_columns(spark):
    """Nulls, empty and long texts, repeated rows and columns of any name and type, through every stage."""
    documents = table(spark, FOLDER, "documents").limit(60)
    names = ("target", "limit", "source_size", "source_docs", "part", "root", "label", "key", "node", "ring", "__label")
    odd = documents.withColumns({n: F.lit(n) for n in names}).withColumns(
        {"m": F.create_map(F.lit("a"), F.lit(1)), "row": F.array(F.lit(1)), "spans": F.lit(None).cast("string")}
    )
    blank = odd.limit(3).withColumn("text", F.lit(None).cast("string"))
    empty = odd.limit(3).withColumn("text", F.lit("")).withColumn("doc_id", F.lit(None).cast("long"))
    long = odd.limit(1).withColumn("text", F.repeat("text", F.lit(40))).withColumn("source", F.lit(None).cast("string"))
    given = odd.union(odd.limit(10)).union(blank).union(empty).union(long).cache()
    for frame in (given, given.where("false")):
        docs = frame
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, FOLDER)
            assert docs.columns == given.columns, name
            kept = docs.collect()
            assert all(r.target == "target" and r.m == {"a": 1} and r.row == [1] for r in kept)
            docs = spark.createDataFrame(kept, docs.schema)
        assert bool(kept) == (frame is given)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == len(kept)
        # Each stage takes the odd rows themselves, too.
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, frame, FOLDER).collect()


def test_near_copies_by_fingerprint_go_too(spark):
    """The stage keeps operator 8: texts with near fingerprints are copies, though their sets of shingles differ."""
    often = "the same few words come again and again in this text " * 60
    texts = [often + " ".join(f"{c}{i}" for i in range(12)) for c in "ab"] + ["another text of its own"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.component_id for r in simhash.components_of(docs).collect()} == {0, 2}
    assert brute_groups(texts) == [0, 1, 2]
    kept = dict(corpus_pipeline.STAGES)["simhash_near_copies"](spark, docs, FOLDER).collect()
    assert sorted(r.doc_id for r in kept) == [0, 2]
