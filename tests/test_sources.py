import pytest
from pyspark.sql import functions as F

from textfeat.operators import clean, hashing, subjects, terms
from textfeat.sources import datasets, library, metadata

START = "\r\n*** START OF X GUTENBERG Y ***\r\n"


@pytest.fixture
def tree(tmp_path):
    def put(name, content):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode())

    put("a/1-0.txt", "[EBook #1]" + START + "Utf text\r\n")
    put("a/1-8.txt", "[EBook #1]" + START + "Latin text")
    put("b/sub/1.txt", "[EBook #1]" + START + "Ascii text")
    put("a/2-0.txt", "x" * 3000)
    put("a/2.txt", "[EBook #2] small")
    put("a/3.zip", "PK")
    put("a/4.txt", "")
    put("a/.h.txt", "hidden")
    put("a/_u.txt", "hidden")
    put("b/5.txt", b"caf\xe9 x")
    put("c/6.txt", "not listed")
    return tmp_path


def test_library(spark, tree):
    found = library.read_library(spark, f"{tree}/", ["a", "b"], max_mib=2000 / 1048576)
    texts = {r.path.rsplit("/", 1)[1]: r.text for r in found.collect()}
    # 1: the UTF-8 variant of three; 2: its preferred variant is too large; 4: empty.
    assert set(texts) == {"1-0.txt", "5.txt"}
    assert texts["1-0.txt"] == "[EBook #1]\n*** START OF X GUTENBERG Y ***\nUtf text"
    books = clean.identify(found, keep_unidentified=True)
    assert {tuple(r) for r in books.collect()} == {(1, "Utf text"), (-1, texts["5.txt"])}
    assert clean.identify(found).count() == 1


def test_charset(spark, tree):
    found = library.read_texts(spark, [f"{tree}/b"], 1.0, charset="ISO-8859-1")
    assert "café x" in [r.text for r in found.collect()]


def test_charset_by_variant(spark, tree):
    for name, content in {"d/7-8.txt": "[EBook #7] na\xefve \xc3\xa9".encode("latin-1"), "d/8-0.txt": "[EBook #8] na\xefve".encode(), "d/9.txt": b"[EBook #9] caf\xe9"}.items():
        (tree / name).parent.mkdir(exist_ok=True)
        (tree / name).write_bytes(content)
    found = library.read_library(spark, str(tree), ["d"], 1.0, charset=library.BY_VARIANT)
    assert {r.doc_id: r.body for r in clean.identify(found).collect()} == {7: "[EBook #7] na\xefve \xc3\xa9", 8: "[EBook #8] na\xefve", 9: "[EBook #9] caf\xe9"}
    words = terms.term_counts(clean.identify(found)).where("doc_id <> 8").collect()
    assert {"naïve", "café"} <= {r.word for r in words}  # kept whole


def test_texts_are_not_shuffled_and_patterns_run_once(spark, tree):
    found = clean.identify(library.read_library(spark, f"{tree}/", ["a", "b"], 1.0, max_rows=2))
    plan = found._jdf.queryExecution().executedPlan().toString()
    texts = plan[plan.index("Generate") :]
    scan = texts.index("FileScan text")
    assert "Exchange hash" not in texts[:scan] and "SortMergeJoin" not in texts[:scan] and "Exchange SinglePartition" not in texts[:scan]
    assert plan.count("(ebook|etext)") == 1 and plan.count(r"\r\n?") == 1
    assert plan.index("(ebook|etext)") < plan.index("BroadcastHashJoin")  # of chosen files only


def test_size_bound_is_inclusive(spark, tree):
    found = library.read_texts(spark, [f"{tree}/a"], 3000 / 1048576)
    assert "2-0.txt" in {r.path.rsplit("/", 1)[1] for r in found.collect()}


def test_files_are_pruned_by_metadata(spark, tree):
    plan = library.read_texts(spark, [f"{tree}/a"], 1.0)._jdf.queryExecution().executedPlan().toString()
    assert "_metadata" in plan or "file_size" in plan


def test_variant_ties_go_by_path(spark):
    files = spark.createDataFrame([("b/7.txt", "7.txt", 1), ("a/7.txt", "7.txt", 2)], "path string, name string, n_bytes long")
    assert [r.path for r in clean.dedupe_variants(files).collect()] == ["a/7.txt"]


def test_stop_words(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("the,of\n, A\n")
    found = library.read_stop_words(spark, str(tmp_path / "stop.txt"))
    assert sorted(r.word for r in found.collect()) == ["", " A", "of", "the"]


NAMESPACES = (
    'xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:dcterms="http://purl.org/dc/terms/" '
    'xmlns:dcam="http://purl.org/dc/dcam/" xmlns:pgterms="urn:pgterms"'
)


def rdf(*books):
    return f'<?xml version="1.0"?>\n<rdf:RDF {NAMESPACES}>{"".join(books)}</rdf:RDF>'


def book(number, *subjects):
    return f'<pgterms:ebook rdf:about="ebooks/{number}">{"".join(subjects)}</pgterms:ebook>'


def subject(value=None, taxonomy=None):
    parts = f'<dcam:memberOf rdf:resource="{taxonomy}"/>' if taxonomy else ""
    parts += f"<rdf:value>{value}</rdf:value>" if value else ""
    return f"<dcterms:subject><rdf:Description>{parts}</rdf:Description></dcterms:subject>"


def test_metadata(spark, tmp_path):
    texts = {
        "1.rdf": rdf(book(11, subject("One", "T"))),
        "2.rdf": rdf(book(12, subject("A &amp; B", "T"), subject(None, "T"), subject("V"), "<dcterms:subject/>")),
        "3.rdf": rdf(book(13)),
        "4.rdf": "<a><b></a>",
        "5.rdf": rdf(book(11, subject("Late", "T"))),
        "6.rdf": rdf(book(14, subject("P", "T")), book(15, subject("Q", "T"))),
        ".7.rdf": rdf(book(16, subject("Hidden", "T"))),
    }
    for name, content in texts.items():
        (tmp_path / name).write_text(content)
    found = {r.doc_id: [tuple(s) for s in r.subjects] for r in metadata.read_metadata(spark, str(tmp_path), strict=False).collect()}
    assert found == {
        11: [("Late", "T")],
        12: [("A & B", "T"), (None, "T"), ("V", None)],
        13: [],
        14: [("P", "T"), ("Q", "T")],
    }
    bad = spark.createDataFrame([("<a><b></a>",)], "text string")
    assert [tuple(r) for r in metadata.parse_rdf(bad).collect()] == [(None, [])]


def test_subject_csv(spark, tmp_path):
    meta = spark.createDataFrame([(1, [("S, x", "T"), ("é", "U")]), (2, [])], "doc_id long, subjects array<struct<subject:string,taxonomy:string>>")
    datasets.write_csv(subjects.flatten_subjects(meta), str(tmp_path / "csv"))
    back = spark.read.csv(str(tmp_path / "csv"), header=True)
    assert {tuple(r) for r in back.collect()} == {("1", "S, x", "T"), ("1", "é", "U")}


def test_vectors_keep_batches_and_lengths_apart(spark, tmp_path):
    path = str(tmp_path / "vectors")

    def write(doc_id, num_bins, batch, weight=0.5):
        rows = [(doc_id, num_bins, 3, weight), (doc_id, num_bins, 1, 0.25)]
        hashed = spark.createDataFrame(rows, "doc_id long, num_bins int, bin long, weight double")
        datasets.write_vectors(hashing.assemble_vectors(hashed), path, batch)

    write(1, 8, 0)
    write(1, 16, 0)
    write(2, 8, 1)
    write(2, 8, 1, weight=0.75)
    found = {r.doc_id: r.features for r in datasets.read_vectors(spark, path, 8).collect()}
    assert set(found) == {1, 2}
    assert found[1].size == 8 and found[1].toArray().tolist() == [0, 0.25, 0, 0.5, 0, 0, 0, 0]
    assert found[2].toArray()[3] == 0.75
    plan = datasets.read_vectors(spark, path, 8)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(num_bins" in plan


def test_dataset_round_trip(spark, tmp_path):
    df = spark.range(5).select("id", F.array("id").alias("ids"))
    datasets.write_dataset(df, str(tmp_path / "d"))
    datasets.write_dataset(df, str(tmp_path / "d"))
    assert sorted(datasets.read_dataset(spark, str(tmp_path / "d")).collect()) == sorted(df.collect())


def test_metadata_of_other_prefixes_and_malformed_files(spark, tmp_path):
    xml = """<r:RDF xmlns:r="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:p="http://www.gutenberg.org/2009/pgterms/"
      xmlns:d="http://purl.org/dc/terms/" xmlns:m="http://purl.org/dc/dcam/"><p:ebook r:about="ebooks/21">
      <d:subject><r:Description><m:memberOf r:resource="T"/><r:value>S</r:value></r:Description></d:subject></p:ebook></r:RDF>"""
    (tmp_path / "a.rdf").write_text(xml)
    found = [(r.doc_id, [tuple(s) for s in r.subjects]) for r in metadata.read_metadata(spark, str(tmp_path)).collect()]
    assert found == [(21, [("S", "T")])]
    (tmp_path / "b.rdf").write_text("<a><b></a>")
    with pytest.raises(Exception, match="no document id in .*b.rdf"):
        metadata.read_metadata(spark, str(tmp_path)).collect()
    assert metadata.read_metadata(spark, str(tmp_path), strict=False).count() == 1


def test_catalogue_of_one_file(spark, tmp_path):
    odd = [
        book(11, subject("Early", "T")),
        '<pgterms:ebook rdf:about="ebooks/21"/>',
        "<pgterms:ebook rdf:about='ebooks/22' note=\"a/>b\" />",
        book(12, subject("A &amp; B", "T"), subject(None, "T"), subject("V")),
        '<pgterms:ebook rdf:about="ebooks/13"><a><b></a></pgterms:ebook>',
        "<pgterms:ebook rdf:nodeID='x'></pgterms:ebook>",
        "<pgterms:ebooks>no record</pgterms:ebooks>",
        book(11, subject("Late\nlines", "T")),
    ]
    many = [book(1000 + i, subject(f"S{i % 7}", "T")) for i in range(3000)]
    last = '<pgterms:ebook rdf:about="ebooks/23"/>'
    (tmp_path / "all.rdf").write_text(rdf(*odd[:4], *many, *odd[4:], last))
    limits = {"spark.sql.files.maxPartitionBytes": "50k", "spark.sql.files.openCostInBytes": "1k"}
    for key, value in limits.items():
        spark.conf.set(key, value)
    try:
        found = {r.doc_id: [tuple(s) for s in r.subjects] for r in metadata.read_catalogue(spark, str(tmp_path), strict=False).collect()}
        assert metadata.read_records(spark, str(tmp_path)).select(F.spark_partition_id()).distinct().count() > 4
        bad = [r.record for r in metadata.bad_records(spark, str(tmp_path)).collect()]
    finally:
        for key in limits:
            spark.conf.unset(key)
    assert {k: v for k, v in found.items() if k < 1000} == {
        11: [("Late\nlines", "T")],
        12: [("A & B", "T"), (None, "T"), ("V", None)],
        21: [],
        22: [],
        23: [],
    }
    assert {k: v for k, v in found.items() if k >= 1000} == {1000 + i: [(f"S{i % 7}", "T")] for i in range(3000)}
    assert sorted(bad) == sorted(odd[4:6])
    with pytest.raises(Exception, match="no document id in .*all.rdf"):
        metadata.read_catalogue(spark, str(tmp_path)).collect()


def test_catalogue_that_breaks_off_and_other_element_names(spark, tmp_path):
    text = rdf(book(1, subject("One", "T")), book(2, subject("Two", "T"))).replace("pgterms:", "")
    (tmp_path / "cut.rdf").write_text(text[: text.index("Two")])
    assert [r.doc_id for r in metadata.read_catalogue(spark, str(tmp_path), "ebook", strict=False).collect()] == [1]
    assert metadata.bad_records(spark, str(tmp_path), "ebook").count() == 1
    assert metadata.read_catalogue(spark, str(tmp_path)).count() == 0  # no such element


def test_bucketed_datasets_meet_without_a_shuffle(spark, tmp_path):
    paths = [str(tmp_path / name) for name in ("left", "right")]
    left = spark.range(1000).selectExpr("id % 100 AS doc_id", "id AS `odd ``name`", "array(struct(id AS a, 'x' AS b)) AS items")
    right = spark.range(100).selectExpr("id AS doc_id", "id * 2 AS value")
    with pytest.raises(Exception):
        datasets.read_bucketed(spark, paths[0])
    for rows, path in zip((right, right), paths):
        datasets.write_bucketed(rows, path, buckets=3)
    datasets.write_bucketed(left, paths[0], buckets=3)  # replaced, with other columns
    a, b = (datasets.read_bucketed(spark, path) for path in paths)
    assert a.dtypes == left.dtypes and sorted(map(str, a.collect())) == sorted(map(str, left.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = a.groupBy("doc_id").agg(F.count("items").alias("n")).join(b, "doc_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SelectedBucketsCount: 3 out of 3" in plan
        assert {tuple(r) for r in joined.collect()} == {(i, 10, 2 * i) for i in range(100)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
