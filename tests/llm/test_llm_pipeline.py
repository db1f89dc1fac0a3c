"""The registered queries and the pipeline on the smallest tables."""

import hashlib
import re
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tierloom.llm.queries import QUERIES, REGISTERED_SQL
from tools.check_oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"

COLUMNS = {
    "op1": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op2": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op3": "vec_id n_links component_id kept",
    "op4": "doc_id class_id n_links kept",
    "op5": "page_id payload_bytes payload_digest record_type refers_to",
    "op6": "doc_id held_out lang_pred score",
    "op7": "doc_id size text_crc32 law shard slot grown_shard",
    "op8": "doc_id held_out score predicted",
    "op9": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op10": "doc_id size source_size target taken",
    "op11": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op12": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
    "op13": "lang rank phrase a l r n score",
}
#: Operators that return one row for each row of a table.
ROW_BY_ROW = {"op3": "embeddings", "op5": "pages"} | {f"op{n}": "documents" for n in (1, 2, 4, 6, 7, 8, 9, 10)}


def test_all_thirteen_are_registered():
    assert {q.split("_")[0] for q in QUERIES} == set(COLUMNS)


@pytest.mark.parametrize("name", QUERIES)
def test_columns_of(spark, name):
    df = QUERIES[name](spark, FOLDER)
    operator = name.split("_")[0]
    wanted = COLUMNS[operator].split()
    assert df.columns[: len(wanted)] == wanted
    if operator in ROW_BY_ROW:
        assert df.count() == spark.read.parquet(f"{FOLDER}/{ROW_BY_ROW[operator]}.parquet").count()
    elif operator == "op11":  # pieces of every document
        assert df.select("doc_id").distinct().count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    elif operator == "op12":
        assert df.count() == spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id").distinct().count()


@pytest.mark.parametrize("name", REGISTERED_SQL)
def test_against_sql(spark, name):
    result = compare(spark, connect(FOLDER), FOLDER, name, QUERIES[name], REGISTERED_SQL[name])
    assert not result.startswith("FAIL"), result


def test_pipeline_stage_by_stage(spark):
    """Each stage keeps the documents' columns; near-duplicates and encoding are redone by hand."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, results = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        results.append(corpus_pipeline.stored(stage(spark, results[-1], FOLDER), name))
    assert all(r.columns == columns for r in results[:-1])
    rows = [r.collect() for r in results]
    ids = [{r.doc_id for r in some} for some in rows]
    for before, after in zip(ids, ids[1:]):
        assert after <= before
    whole = {r.doc_id: r for r in rows[0]}
    assert all(whole[r.doc_id] == r for some in rows[1:5] for r in some)

    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    clean = [i for i in ids[1] if labels.get(i) == 0]
    assert sum(i in ids[2] for i in clean) >= 0.98 * len(clean)

    shingles = {}
    for r in rows[2]:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        shingles[r.doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    near = {i: {i} for i in shingles}
    for i in shingles:
        for j in shingles:
            if i < j and shingles[i] and 5 * len(shingles[i] & shingles[j]) >= 4 * len(shingles[i] | shingles[j]):
                both = near[i] | near[j]
                for k in both:
                    near[k] = both
    assert ids[3] == {min(c) for c in near.values()}
    assert max(Counter(r.doc_id for r in rows[4]).values()) <= 2

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in rows[5]:
        wanted = library.encode(whole[r.doc_id].text, add_special_tokens=False).ids
        assert r.ids == wanted
        assert r.decoded_sha256 == hashlib.sha256(library.decode(wanted, skip_special_tokens=False).encode()).hexdigest()


#: Names that stages use themselves, here as columns of the documents.
CLASHING = ["row", "key", "check", "score", "predicted", "size", "place", "copy", "shard", "_text"]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Documents with odd rows among them, in a folder with labels that hold NULLs; and the texts that the odd rows have."""
    folder = str(tmp_path_factory.mktemp("odd"))
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    clean = docs.join(labels.where("toxic = 0"), "doc_id").where("length(text) BETWEEN 400 AND 3000").orderBy("doc_id").limit(3)
    turned = [" ".join(reversed(r.text.split())) for r in clean.collect()]
    long_text = " ".join(turned[2].split() * 400)
    odd_rows = [
        (None, turned[0], None, None, None),
        (9005, turned[1], "en", "web", 1),
        (9005, turned[1], "en", "web", 1),
        (9006, long_text, None, "web", None),
        (9007, None, "en", "web", 0),
        (9008, "", "en", None, 0),
        (9009, "12 34 !", None, "web", 7),
        (None, None, None, None, None),
    ]
    every = docs.unionByName(spark.createDataFrame(odd_rows, docs.schema))
    for name in CLASHING:
        every = every.withColumn(name, every.doc_id)
    every.write.parquet(f"{folder}/documents.parquet")
    none = spark.createDataFrame([(None, 1, 1), (9005, None, None), (9007, 0, 1)], labels.schema)
    labels.unionByName(none).write.parquet(f"{folder}/labels.parquet")
    return folder, turned, long_text


def test_pipeline_with_odd_rows(spark, odd):
    folder, turned, long_text = odd
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), name)
        kept[name] = docs.collect()
        if name != "encoding":
            assert docs.columns == columns
            texts = Counter(r.text for r in kept[name])
            assert not {None, "", "12 34 !"} & set(texts)  # of no language
            if name != "mixing":
                assert texts[turned[0]] == 1 and texts[long_text] == 1
                assert texts[turned[1]] == (1 if name == "near_duplicates" else 2)
                assert [r.doc_id for r in kept[name] if r.text == turned[0]] == [None]
    assert max(Counter((r.doc_id, r.text) for r in kept["mixing"]).values()) <= 2
    assert Counter(r.doc_id for r in kept["encoding"]) == Counter(r.doc_id for r in kept["mixing"])


def test_later_stages_with_texts_that_the_first_one_drops(spark, odd):
    folder, turned, _ = odd
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    odd_ids = "doc_id IS NULL OR doc_id >= 9000"
    clean = Counter((r.doc_id, r.text) for r in stages["toxicity"](spark, docs, folder).where(odd_ids).collect())
    assert clean == Counter((r.doc_id, r.text) for r in docs.where(odd_ids).collect())

    odd_docs = docs.where(odd_ids)
    alone = Counter(r.text for r in stages["near_duplicates"](spark, odd_docs, folder).collect())
    assert alone[turned[0]] == alone[turned[1]] == alone["12 34 !"] == 1
    mixed = stages["mixing"](spark, odd_docs, folder)
    assert mixed.columns == docs.columns and 0 < mixed.count() <= 2 * odd_docs.count()
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    codes = stages["encoding"](spark, odd_docs, folder).collect()
    assert len(codes) == odd_docs.count()
    assert [r.ids_sha256 for r in codes if r.doc_id in (9007, 9008)] == [empty, empty]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_of_no_documents(spark, odd, name):
    docs = spark.read.parquet(f"{odd[0]}/documents.parquet")
    result = dict(corpus_pipeline.STAGES)[name](spark, docs.limit(0), odd[0])
    assert result.count() == 0
    assert name == "encoding" or result.columns == docs.columns
