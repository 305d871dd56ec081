import random
from pathlib import Path

from textfeat.operators import clean, models
from textfeat.plans import runs, staging
from textfeat.sources import datasets, library, metadata


def test_files_to_results(spark, tmp_path):
    """A small library with its metadata, through every stage and the files between them."""
    rng = random.Random(2)
    (tmp_path / "lib" / "a").mkdir(parents=True)
    (tmp_path / "rdf").mkdir()
    (tmp_path / "stop.txt").write_text("the,of\n")
    for number in range(1, 61):
        topic = "Art" if number % 2 else "Sea"
        own = ["paint", "brush", "canvas"] if topic == "Art" else ["ship", "wave", "sail"]
        body = " ".join(["the", "of"] + rng.choices(own, k=8) + rng.choices(["one", "two"], k=4))
        head, foot = "*** START OF THE GUTENBERG BOOK ***", "*** END OF THE GUTENBERG BOOK ***"
        content = f"Head\n[EBook #{number}]\n{head}\n{body}\n{foot}\nlicence words\n"
        (tmp_path / "lib" / "a" / f"{number}-0.txt").write_text(content)
        (tmp_path / "lib" / "a" / f"{number}-8.txt").write_text(content.replace(body, "worse variant"))
        (tmp_path / "rdf" / f"pg{number}.rdf").write_text(
            '<rdf:RDF xmlns:rdf="r" xmlns:dcterms="t" xmlns:dcam="d" xmlns:pgterms="p">'
            f'<pgterms:ebook rdf:about="ebooks/{number}"><dcterms:subject><rdf:Description>'
            f'<dcam:memberOf rdf:resource="T"/><rdf:value>{topic}</rdf:value>'
            "</rdf:Description></dcterms:subject></pgterms:ebook></rdf:RDF>"
        )

    folder = Path(staging.shared_folder(spark)) / "textfeat"

    def staged():
        return {p.name for p in folder.iterdir()} if folder.exists() else set()

    before = staged()
    docs = clean.identify(library.read_library(spark, str(tmp_path / "lib"), ["a"], max_mib=1.0))
    corpus = runs.count_corpus(docs, stop_words=library.read_stop_words(spark, str(tmp_path / "stop.txt")))
    words = {r.word for r in corpus.vocabulary().collect()}
    assert words == {"paint", "brush", "canvas", "ship", "wave", "sail", "one", "two"}

    path = str(tmp_path / "vectors")
    runs.build_vectors(corpus, [32, 64], 1.0, path)
    corpus.release()
    vectors = datasets.read_vectors(spark, path, 32)
    assert vectors.count() == 60 and vectors.first().features.size == 32
    assert datasets.read_vectors(spark, path, 64).count() == 60

    meta = metadata.read_metadata(spark, str(tmp_path / "rdf"))
    results = runs.classify(vectors, meta, [1, 2], 3, seed=3, settings=[models.naive_bayes(0.5)])
    tests = results.where("`set` = 'Test'").collect()
    assert {r.subject for r in tests} == {"Art", "Sea"} and all(r.accuracy == 1.0 for r in tests)
    assert staged() == before
