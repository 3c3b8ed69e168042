"""Classifiers, language identification, packing: held-out accuracy, brute force and odd rows."""

import re
import zlib

import numpy as np
import pytest

from duelmetrics.llm import language_id, packing, quality, toxicity

SF_DIR = "/root/testdata/sf0.01"
ODD = "doc_id long, text string, lang string, source string, n_chars long, score double, extra int"
ODD_ROWS = [(1, None, "en", None, None, 0.5, 1), (2, "", None, "s", 0, None, None), (3, " \n\t ", "en", "s", 3, 1.0, 2),
            (None, "word " * 30, "en", "s", 1, 1.0, 3), (5, "12 34 !!", "de", "s", 1, 1.0, 4),
            (6, "é ü 漢字 <|endoftext|>", "fr", "s", 1, 1.0, 5), (6, "é ü 漢字 <|endoftext|>", "fr", "s", 1, 1.0, 5),
            (7, "long " * 40_000, "en", "s", 200_000, 1.0, 6)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, ODD)


@pytest.fixture(scope="module")
def queries():
    from duelmetrics.llm import queries

    return queries.ALL


def test_language_of_held_out_documents(spark, queries):
    rows = queries["op10_language_id"](spark, SF_DIR)
    lang = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    got = rows.join(lang, "doc_id").where("held_out").collect()
    assert len(got) > 100
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def longest_phrases(text, sample):
    """Phrases of a greedy parse, by search."""
    count = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at:at + size + 1] in sample:
            size += 1
        at += size
        count += 1
    return count


def test_phrases_equal_a_search():
    rng = np.random.default_rng(4)
    samples = tuple((name, "".join(rng.choice(list(letters), 400))) for name, letters in (("a", "xyz "), ("b", "xyyw ")))
    parser = language_id.Parser(samples)
    texts = ["".join(rng.choice(list("xyzw"), n)) for n in (1, 2, 30, 300)]
    bits, length = parser.entropies(texts)
    for k, text in enumerate(texts):
        for n, (_, sample) in enumerate(samples):
            folded = "".join(chr(c) if c else " " for c in language_id._folded(sample)) + " "
            assert length[k] == len(text)
            assert bits[k, n] * len(text) / parser.bits[n] == pytest.approx(longest_phrases(text, folded))


def test_phrases_in_large_alphabets():
    """Each language has hundreds of letters of its own, beyond those of the others."""
    rng = np.random.default_rng(6)
    scripts = {"ja": [chr(c) for c in range(0x3041, 0x3090)], "ko": [chr(c) for c in range(0xAC00, 0xAE00)],
               "zh": [chr(c) for c in range(0x4E00, 0x5000)], "zu": list("abcdefgh"), "yue": [chr(c) for c in range(0x4F80, 0x5180)]}
    samples = tuple((name, " ".join("".join(rng.choice(letters, 5)) for _ in range(400))) for name, letters in scripts.items())
    parser = language_id.Parser(samples)
    texts = ["".join(rng.choice(letters, 40)) + sample[:30] for (_, sample), letters in zip(samples, scripts.values())]
    bits, length = parser.entropies(texts)
    folds = {name: "".join(chr(c) if c else " " for c in language_id._folded(sample)) + " " for name, sample in samples}
    for k, text in enumerate(texts):
        assert parser.labels[bits[k].argmin()] == samples[k][0]
        for n, name in enumerate(parser.labels):
            assert bits[k, n] * length[k] / parser.bits[n] == pytest.approx(longest_phrases(text, folds[name]))


def test_languages_of_long_documents_alone(spark):
    """Labelled texts beyond the bound of a document are learned from too, wherever their letters are."""
    rows = [("en", "the word of a long list and the words of it"), ("fi", "yksi sana ja toinen sana on t\u00e4ss\u00e4 " * 2000),
            ("el", "\u03bc\u03b9\u03b1 \u03bb\u03ad\u03be\u03b7 " + "1 2\n" * 20_000), ("--", "1 2 3"), (None, "nothing"), ("xx", None)]
    samples = language_id.sample_texts(spark.createDataFrame(rows, "lang string, text string"), "text", "lang")
    assert [name for name, _ in samples] == ["el", "en", "fi"]
    assert all(len(text) <= language_id.SAMPLE_DOC_CHARS for _, text in samples)
    assert language_id.Parser(tuple(samples)).labels == ["el", "en", "fi"]
    docs = spark.createDataFrame([("fi", "toinen sana on t\u00e4ss\u00e4"), ("el", "\u03bb\u03ad\u03be\u03b7"), ("en", "the words")], "lang string, text string")
    assert all(r.lang_pred == r.lang for r in language_id.identify(docs, samples).collect())


def test_language_of_odd_rows(spark, odd):
    samples = [("en", "the word of a long list and the words of it"), ("fr", "é ü un mot de la liste")]
    rows = language_id.identify(odd, samples)
    assert rows.columns == ["doc_id", "lang", "source", "n_chars", "extra", "lang_pred", "score"]
    got = rows.collect()
    assert len(got) == len(ODD_ROWS)
    assert [r.lang_pred for r in got if r.doc_id in (1, 2, 3, 5)] == ["und"] * 4
    assert {r.lang_pred for r in got if r.doc_id in (7, None)} == {"en"}
    assert {r.lang_pred for r in language_id.identify(odd, []).collect()} == {"und"}
    assert language_id.identify(odd.limit(0), samples).count() == 0


def test_quality_of_held_out_documents(spark, queries):
    rows = queries["op5_quality"](spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    got = rows.join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def plain_statistics(text):
    b = (text or "").encode()
    words = [w for w in re.split(rb"[\x20\x09-\x0d]+", b) if w]
    lines = [x for x in b.split(b"\n") if x]
    n, size = max(len(words), 1), max(len(b), 1)
    count = lambda marks: sum(c in marks for c in b)
    up, low = count(range(65, 91)), count(range(97, 123))
    symbols = b"#$%&*+/<=>@\\^_`{}~"
    return {"log_bytes": np.log1p(len(b)), "log_words": np.log1p(len(words)), "mean_word": sum(map(len, words)) / n,
            "longest_word": np.log1p(max(map(len, words), default=0)), "distinct_words": len({w.lower() for w in words}) / n,
            "upper": up / max(up + low, 1), "digits": count(b"0123456789") / size, "stops": count(b".?") / n, "commas": count(b",;:") / n,
            "shouts": count(b"!") / n, "bars": count(b"|") / n, "symbols": count(symbols) / size, "other_marks": count(b"\"'()-[]") / size,
            "wide": count(range(192, 256)) / size, "spaces": count(b" ") / size, "mean_line": np.log1p(len(b) / max(len(lines), 1)),
            "repeated_lines": 1 - len(set(lines)) / len(lines) if lines else 0.0, "short_words": sum(len(w) <= 2 for w in words) / n,
            "marked_words": sum(w[-1] in b"!|" + symbols for w in words) / n}


def test_every_statistic_equals_a_plain_one(spark):
    texts = [r[1] for r in ODD_ROWS] + ["One two, THREE!! four|five. Six?\nOne\n\nsame line\nsame line\n", "\n\n", "#tag $5 50% (a) [b] 'c' \"d\" e-mail_x@y.z",
                                        "\t tabs\vand\fmore\r\nÉté ÀÇ 漢字", "a\x00b \x00", "!", "x" * 5000, "Aa aA AA aa"]
    rng = np.random.default_rng(31)
    texts += ["".join(rng.choice(list("aB1 .,!|#'\n\té漢"), 200)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for r in quality.statistics(docs).collect():
        want = plain_statistics(texts[r.id])
        assert set(want) == set(quality.STATISTICS)
        assert {k: r[k] for k in want} == pytest.approx(want), texts[r.id]


def test_rules_as_columns_equal_the_rules_by_hand(spark):
    rules = quality.Rules(0.25, [(1.5, (("upper", "<=", 0.1), ("digits", ">", 0.2))), (-2.0, (("shouts", ">", 0.0),))])
    docs = spark.createDataFrame([(1, "AB 12"), (2, "ab 123!"), (3, "a1!"), (4, None)], "id int, text string")
    got = {r.id: r for r in quality.statistics(docs).withColumn("s", rules.score()).collect()}
    for r in got.values():
        total = 0.25 + (1.5 if r.upper <= 0.1 and r.digits > 0.2 else 0) + (-2.0 if r.shouts > 0 else 0)
        assert r.s == pytest.approx(1 / (1 + np.exp(-total)))
    assert got[2].digits == pytest.approx(3 / 7) and got[4].log_bytes == 0


def test_tree_paths_from_text():
    text = "Tree 0 (weight 1.0):\n  If (feature 0 <= 1.5)\n   If (feature 1 <= 2.0)\n    Predict: 0.0\n   Else (feature 1 > 2.0)\n    Predict: 1.0\n  Else (feature 0 > 1.5)\n   Predict: 1.0"
    assert quality.tree_paths(text, ("a", "b")) == {
        (("a", "<=", 1.5),), (("a", "<=", 1.5), ("b", "<=", 2.0)), (("a", "<=", 1.5), ("b", ">", 2.0)), (("a", ">", 1.5),)}


def test_quality_of_odd_rows(spark, odd):
    got = quality.score(odd, quality.Rules(0.0)).collect()
    assert len(got) == len(ODD_ROWS) and {r.score for r in got} == {0.5}
    nothing = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.learn(odd, nothing) == quality.Rules(0.0)
    same = spark.createDataFrame([(2, 1), (3, 1), (2, None), (None, 0)], "doc_id long, quality int")
    assert quality.learn(odd, same) == quality.Rules(5.0)
    assert quality.score(odd.limit(0), quality.Rules(0.0)).count() == 0


def test_toxicity_of_labelled_documents(spark, queries):
    rows = queries["op4_toxicity"](spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    got = rows.join(labels, "doc_id").collect()
    assert np.mean([r.is_toxic for r in got if r.toxic == 1]) > 0.6
    assert np.mean([r.is_toxic for r in got if r.toxic == 0]) < 0.01


def test_a_chain_equals_its_sum(spark):
    grams = [np.unique(g) for _, _, _, g in toxicity._features(__import__("pyarrow").array(["such an idiot here"]))][0]
    chain = toxicity.Chain(("one", "two"), (grams[:2], grams[1:4]), (np.array([1.0, -0.5]), np.array([0.3, 0.2, 0.1])),
                           (np.zeros(0), np.array([2.0])), (-1.0, 0.5), 0.5)
    docs = spark.createDataFrame([(1, "such an idiot here"), (2, None), (3, "such an idiot here " * 50)], "id int, text string")
    one, two = (lambda z: 1 / (1 + np.exp(-z))), None
    got = {r.id: r for r in toxicity.judge(docs, chain).collect()}
    p1 = one(-1.0 + 0.5)
    assert got[1].p_one == pytest.approx(p1) and got[1].p_two == pytest.approx(one(0.5 + 0.6 + 2 * p1))
    assert got[2].p_one == pytest.approx(one(-1.0)) and got[3].p_one == pytest.approx(got[1].p_one)


def test_toxicity_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (5, None), (None, 1), (6, 1)], "doc_id long, toxic int")
    got = toxicity.judge(odd, toxicity.learn(odd, labels)).collect()
    assert len(got) == len(ODD_ROWS) and all(0 <= r.p_toxic <= 1 for r in got)
    none = toxicity.learn(odd, labels.limit(0))
    assert not any(r.is_toxic for r in toxicity.judge(odd, none).collect())
    assert toxicity.judge(odd.limit(0), none).count() == 0


def check_packing(rows, docs, capacity=2048):
    """Every document is whole, pieces are cut as they must be, sequences are gapless."""
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc, text in docs.items():
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        pieces = sorted(by_doc[doc], key=lambda r: r.piece)
        assert sum(r.length for r in pieces) == len(ids)
        first = len(ids) % capacity or capacity
        for k, r in enumerate(pieces):
            begin = 0 if k == 0 else first + (k - 1) * capacity
            assert (r.piece, r.start) == (k, begin)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[begin:begin + r.length], "<u4").tobytes())
    total = sum(r.length for r in rows)
    for members in by_sequence.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_sequence) * capacity / total


def test_packing_holds_every_id(spark, queries):
    rows = queries["op8_packing"](spark, SF_DIR).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert check_packing(rows, docs) < 1.03


def test_packing_of_odd_rows(spark, odd):
    unique = odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = packing.pack_documents(unique).collect()
    check_packing(rows, {r.doc_id: r.text for r in unique.collect()})
    every = packing.pack_documents(odd).collect()
    assert sum(r.length for r in every if r.doc_id == 6) == 2 * sum(r.length for r in rows if r.doc_id == 6)
    assert packing.pack_documents(odd.limit(0)).count() == 0


def test_special_tokens_inside_texts(spark):
    """Their strings are their ids wherever they stand, as the contract's library gives them by default."""
    import public_tokenizers
    from tokenizers import Tokenizer

    mark = "<|endoftext|>"
    texts = [mark, f"{mark}a b", f"a {mark} b", f"a b{mark}", f"a b {mark}", f"x{mark}{mark}y", f"{mark}  {mark}\n", f"don't{mark}'t stop {mark}s",
             "<|endoftext", f"<{mark}>", f"é{mark}漢", f"word  {mark}  word", f"{mark} " * 3000, "<|startoftext|>"]
    rows = packing.pack_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    check_packing(rows, dict(enumerate(texts)))
    encode, path = packing.encoder(packing.default_tokenizer()), public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    for text in texts:
        assert encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids
    assert encode("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]
    # A file whose ids aren't ranks goes through the library itself.
    other = public_tokenizers.path("word_bpe_49k.json")
    assert packing.encoder(other)("Some Words").tolist() == Tokenizer.from_file(other).encode("Some Words", add_special_tokens=False).ids


def test_best_fit_against_a_list_of_bins():
    rng = np.random.default_rng(5)
    for limit in (1, 3, 50):
        bins, free, open_, made = packing.OpenBins(100, limit), {}, [], 0
        for length in rng.integers(1, 101, 500).tolist():
            number, offset = bins.place(length)
            fits = [free[b] for b in open_ if free[b] >= length]
            if fits:
                assert free[number] == min(fits) and number in open_
            else:
                assert number == made
                made, free[number] = made + 1, 100
                open_.append(number)
            assert offset == 100 - free[number]
            free[number] -= length
            if not free[number]:
                open_.remove(number)
            if len(open_) > limit:
                least = min(free[b] for b in open_)
                closed = [b for b in open_ if free[b] == least]
                still = {b for bins_ in bins.by_free for b in bins_}
                gone = [b for b in closed if b not in still]
                assert len(gone) == 1
                open_.remove(gone[0])
