import hashlib
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from textfeat.llm import fingerprints, langid, lines, quality, queries, simhash

SF = "/root/testdata/sf0.001"
ROWS = [(5, "a b c d e f"), (4, None), (3, ""), (3, "x"), (None, "n u l l"), (None, "other"), (2, "a b c d e f"), (2, "a b c d e f"), (1, "é" * 5000)]


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def test_op3_equals_brute_force(spark, texts):
    order = sorted(texts, reverse=True)
    after = dict(zip(order, order[1:] + order[:1]))

    def sketch(text):
        w = words(text)
        found = {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
        return found

    rows = queries.op3_fingerprints(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    errors = []
    for r in rows:
        text, other = texts[r.doc_id], texts[after[r.doc_id]]
        third = len(text) // 3
        edited = text[: len(text) - third] + other[:third]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        ours = sketch(text)
        if len(ours) >= 100:
            errors.append(r.near_edited - len(ours & sketch(edited)) / len(ours))
            assert abs(r.near_next - len(ours & sketch(other)) / len(ours)) < 0.2
    assert len(errors) > 20 and abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.1


def test_fingerprints_of_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in ROWS], "doc_id long, text string, bucket int")
    for buckets in (1, 3, 50):
        found = fingerprints.with_next(docs, buckets).collect()
        assert len(found) == len(ROWS)
        by_id = {(r.doc_id, r.text): r.next_text for r in found}
        assert by_id[5, "a b c d e f"] == "" and by_id[1, "é" * 5000] in ("n u l l", "other")
        assert {r.next_text for r in found if r.doc_id is None} == {"a b c d e f", "n u l l", "other"} - {by_id[1, "é" * 5000]}
    assert fingerprints.with_next(docs.limit(0), 4).count() == 0
    one = fingerprints.with_next(docs.where("doc_id = 5"), 4).first()
    assert one.next_text == one.text


def test_sketches_merge_and_estimate_containment(spark):
    a, b = " ".join(f"w{i}" for i in range(2000)), " ".join(f"w{i}" for i in range(500))
    df = spark.createDataFrame([(a, b, "")], "a string, b string, c string")
    sa, sb, sc = (fingerprints.sketch(F.col(c)) for c in "abc")
    row = df.select(
        fingerprints.containment(sb, sa), fingerprints.containment(sa, sb), fingerprints.containment(sc, sc), fingerprints.containment(sc, sa),
        (fingerprints.merge(sa, sb) == sa), F.length(fingerprints.fingerprint(sa)) == 16 * F.size(sa),
    ).first()
    assert row[0] == 1 and abs(row[1] - 0.25) < 0.06 and row[2] == 1 and row[3] == 0 and row[4] and row[5]


def test_short_texts_are_told_apart(spark):
    rows = [(f"word{i}", f"other{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "a string, b string")
    sa, sb = fingerprints.sketch(F.col("a")), fingerprints.sketch(F.col("b"))
    long = fingerprints.sketch(F.lit(" ".join(f"w{i}" for i in range(100))))
    found = df.select(fingerprints.containment(sa, sb), fingerprints.containment(sa, sa), F.size(sa), fingerprints.merge(sa, long), long, sa).collect()
    limit = int(-(2**63) + fingerprints.FRACTION * 2**64)
    for other, same, size, merged, large, own in found:
        assert (other, same, size) == (0, 1, 1)
        assert merged == sorted({*large, *(h for h in own if h < limit)})


def simhash_of(text):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    parts = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = np.array([xxhash.xxh64_intdigest(p.encode(), 42) for p in parts], np.uint64)
    return sum(1 << b for b in range(64) if len(h) and 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(h))


def components_of(codes, distance=3):
    label = np.arange(len(codes))
    near = np.bitwise_count(codes[:, None] ^ codes) <= distance
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label
        label = new


def test_op9_equals_brute_force(spark, texts):
    ids = sorted(texts)
    codes = np.array([simhash_of(texts[i]) for i in ids], np.uint64)
    label = components_of(codes)
    expected = {i: (f"{c:016x}", ids[k]) for i, c, k in zip(ids, codes.tolist(), label)}
    rows = queries.op9_simhash(spark, SF).collect()
    assert len(rows) == len(ids) and {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == expected


def test_the_gray_tree_decides(spark):
    """On real fingerprints in one cell: some nodes are compared, few pairs are left, and none is lost."""
    found = simhash.fingerprints(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).select("fp").distinct().collect()
    codes = np.sort(np.array([r.fp for r in found], np.int64).view(np.uint64))[::2]
    index = simhash.GrayIndex(simhash.turned(codes, 16))
    index.link()
    every = len(codes) * (len(codes) - 1) // 2
    assert len(codes) > 4000 and 0 < index.node_pairs < every / 10 and index.code_pairs < every / 4
    label = components_of(codes)
    at = {int(c): i for i, c in enumerate(simhash.turned(index.codes, -16))}
    ours = [index.parent[at[int(c)]] for c in codes]
    assert len(set(zip(ours, label.tolist()))) == len(set(ours)) == len(set(label.tolist()))


@pytest.mark.parametrize("cell_rows", [8192, 50])
def test_links_of_near_and_chained_fingerprints(spark, cell_rows):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    flips = [base[:200] ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)) for _ in range(3)]
    chain = [np.uint64(12345)]
    for bit in range(0, 60, 3):  # each three bits from the one before
        chain.append(chain[-1] ^ np.uint64(7 << bit))
    ball = np.array([99 ^ (1 << a) ^ (1 << b) for a in range(30) for b in range(a)], np.uint64)
    codes = np.unique(np.concatenate([base, *flips, np.array(chain), ball]))
    label = components_of(codes)
    df = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "fp long")
    stars = {r.u: r.v for r in simhash.stars(simhash.links(df, cell_rows=cell_rows)).collect()}
    found = [stars.get(int(c), int(c)) for c in codes.view(np.int64)]
    assert len({(a, b) for a, b in zip(found, label)}) == len(set(found)) == len(set(label.tolist()))
    index = simhash.GrayIndex(codes)
    index.link()
    own = components_of(index.codes)
    assert (index.parent == own).all()


def test_simhash_of_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, "f") for i, t in ROWS], "doc_id long, text string, fp string")
    rows = simhash.components(docs).collect()
    assert len(rows) == len(ROWS)
    assert {r.component_id for r in rows if r.doc_id in (3, 4) and r.fp == 0} == {3}
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    # 4 and 3 are without words, 5 and 2 alike; repeated rows count once
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted([("3", ""), ("3", "x"), ("None", "n u l l"), ("None", "other"), ("2", "a b c d e f"), ("1", "é" * 5000)])
    assert simhash.components(docs.limit(0)).count() == 0 and simhash.one_of_each(docs.limit(0)).count() == 0


def dedup_lines(rows):
    seen, out = set(), []
    for doc_id, text in rows:
        split = (text or "").split("\n")
        gone = set()
        for i in range(len(split) - 2):
            window = tuple(split[i : i + 3])
            if any(line.strip(" ") for line in window):
                if window in seen:
                    gone |= {i, i + 1, i + 2}
                seen.add(window)
        out.append((doc_id, None if text is None else "\n".join(x for i, x in enumerate(split) if i not in gone)))
    return out


def test_line_dedup_of_odd_rows(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "x\nb\nc\nd\ny"), (3, "r\nr\nr\nr\nr"), (4, "\n\n\n\n"), (5, "a\nb"), (6, "a\nb"), (7, None), (8, ""), (9, "a\nb\nc\nd"), (10, "p\r\nq\n" * 2000), (11, "q\np\r\nq")]
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id long, text string, starts string, tie int")
    found = lines.dedup(docs)
    assert found.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in found.collect()) == dedup_lines(rows)
    assert lines.dedup(docs.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, "1\n2\n3"), (None, "0\n1\n2\n3"), (4, "1\n2\n3"), (4, "1\n2\n3")], "doc_id long, text string")
    left = [r.text for r in lines.dedup(nulls).collect()]
    assert len(left) == 4 and sorted(left).count("") >= 2


def test_language_of_held_out_texts(spark, texts):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [r for r in queries.op6_language(spark, SF).collect()]
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held]) > 0.95 and all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark):
    train = spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, None, "en"), (4, "123", "fr"), (5, "text", None)], "doc_id long, text string, lang string")
    model = langid.train(train)
    assert model.languages == ["de", "en"]
    ask = spark.createDataFrame([("the dog",), ("und die",), (None,), ("",), ("12 !?",), ("中",), ("and " * 300_000,)], "text string")
    found = [(r.p.lang, r.p.score) for r in ask.select(langid.predict(F.col("text"), model).alias("p")).collect()]
    assert [lang for lang, _ in found] == ["en", "de", "und", "und", "und", found[5][0], "en"] and found[5][0] != "und"
    assert langid.train(train.limit(0)) is None
    assert {r.p.lang for r in ask.select(langid.predict(F.col("text"), None).alias("p")).collect()} == {"und"}


def test_language_scores_do_not_depend_on_the_batch(spark):
    model = langid.Model(["a", "b"], np.random.default_rng(0).integers(0, 9, (1 << langid.BITS, 2)).astype(float), np.array([3.0, 4.0]))
    asked = ["short", "Ein längerer Text", "x", "z" * 1000]
    together = model.predict(asked)
    for i, text in enumerate(asked):
        lang, score = model.predict([text])
        assert lang[0] == together[0][i] and score[0] == pytest.approx(together[1][i])


def test_quality_on_documents_not_learned_from(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rated = queries.ratings(labels)
    model = quality.train(docs, rated.where("doc_id % 4 <> 0"), queries.GRADES)
    assert (np.diff(model.thresholds) >= 0).all()
    held = quality.score(docs, model).join(rated.where("doc_id % 4 = 0"), "doc_id").select("grade", "tails", "expected_grade").collect()
    right = [(r.tails[-1] >= queries.MIN_GOOD) == (r.grade == 2) for r in held]
    kept = [r.tails[-1] >= queries.MIN_GOOD for r in held if r.grade == 2]
    assert len(held) > 900 and np.mean(right) > 0.95 and np.mean(kept) > 0.97
    assert np.mean([r.tails[-1] < queries.MIN_GOOD for r in held if r.grade == 0]) > 0.9
    assert np.mean([r.expected_grade for r in held if r.grade == 0]) < 1 < np.mean([r.expected_grade for r in held if r.grade == 2])


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, "t") for i, t in ROWS], "doc_id long, text string, tails2 string")
    none = spark.createDataFrame([], "doc_id long, grade int")
    model = quality.train(docs, none, 3)
    found = quality.score(docs, model).collect()
    assert len(found) == len(ROWS) and all(r.tails == pytest.approx([2 / 3, 1 / 3]) and r.expected_grade == pytest.approx(1) for r in found)
    ratings = spark.createDataFrame([(5, 2), (5, 2), (1, 0), (None, 1), (3, None), (77, 1)], "doc_id long, grade int")
    assert quality.score(docs, quality.train(docs, ratings, 3)).count() == len(ROWS)
    assert quality.score(docs.limit(0), model).count() == 0


def test_cumulative_link_gradient_finds_an_ordered_scale():
    rng = np.random.default_rng(1)
    grades = rng.integers(0, 4, 2000)
    bins = [np.unique(np.array([g, 10 + rng.integers(0, 50)], np.uint32)) for g in grades]
    model = quality.fit(bins, grades, 4)
    scores = model.scores(bins)
    assert (np.diff([scores[grades == g].mean() for g in range(4)]) > 0.5).all()
    tails = model.tails(scores)
    assert (np.diff(tails, axis=1) <= 1e-12).all() and np.mean((tails > 0.5).sum(1) == grades) > 0.9


def test_sample_holds_for_repeated_ids(spark):
    docs = spark.createDataFrame([(1, f"text {i % 7}") for i in range(60)], "doc_id long, text string")
    ratings = spark.createDataFrame([(1, 0), (1, 2), (None, 1), (2, None)], "doc_id long, grade int")
    model = quality.train(docs, ratings, 3, sample=25)
    again = quality.train(docs.repartition(5), ratings, 3, sample=25)
    assert (model.weights == again.weights).all() and (model.thresholds == again.thresholds).all()


def test_windows_of_another_width(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc"), (2, "x\na\nb\ny"), (3, "c\nz")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in lines.dedup(docs, width=2).collect()} == {1: "a\nb\nc", 2: "x\ny", 3: "c\nz"}
    assert {r.doc_id: r.text for r in lines.dedup(docs, width=1).collect()} == {1: "a\nb\nc", 2: "x\ny", 3: "z"}


def test_quality_of_ids_that_are_strings(spark):
    docs = spark.createDataFrame([(f"d{i}", "fine words" if i % 2 else "bad words") for i in range(40)], "doc_id string, text string")
    ratings = spark.createDataFrame([(f"d{i}", i % 2) for i in range(40)], "doc_id string, grade int")
    scored = quality.score(docs, quality.train(docs, ratings, 2)).collect()
    assert all((r.tails[0] > 0.5) == ("fine" in r.text) for r in scored)


def test_equal_rows_send_one_guest(spark):
    """Each document has one next, however many equal rows a range begins with."""
    docs = spark.createDataFrame([(9, "top")] + [(5, "same")] * 30 + [(1, "end")], "doc_id long, text string")
    found = [(r.doc_id, r.next_text) for r in fingerprints.with_next(docs, 4).collect()]
    assert sorted(found) == sorted([(9, "same")] + [(5, "same")] * 29 + [(5, "end"), (1, "top")])
