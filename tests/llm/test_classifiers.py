"""Language, toxicity, quality and grades: held-out accuracy, and odd rows."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from holdfast.llm import hyper_langid, ordinal_quality, quality_rules, toxicity

LETTERS = {"aa": "abcdeo", "bb": "xyzuik", "cc": "éèàmno"}
BAD = ["idiot", "moron", "stupid"]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    word = lambda lang: "".join(rng.choices(LETTERS[lang], k=rng.randint(2, 7)))
    docs, marks = [], []
    for i in range(400):
        lang = rng.choice(list(LETTERS))
        own = [word(lang) for _ in range(rng.randint(60, 120))]
        toxic, junk = rng.random() < 0.3, rng.random() < 0.3
        if toxic:
            for _ in range(4):
                bad = rng.choice(BAD)
                own.insert(rng.randrange(len(own)), bad if rng.random() < 0.7 else bad.replace("i", "ii", 1).replace("o", "oo", 1))
        if junk:
            own = [w + rng.choice(["###", "$$$", "!!"]) for w in own]
        docs.append((i, " ".join(own), lang))
        marks.append((i, int(not junk), int(toxic)))
    return docs, marks


def held(i, modulus=4):
    return zlib.crc32(str(i).encode()) % modulus == 2


def test_language(documents, corpus, odd_rows):
    rows = {r["doc_id"]: r for r in hyper_langid.identified_documents(documents(corpus[0])).collect()}
    right = [rows[i]["lang_pred"] == lang for i, _, lang in corpus[0] if held(i)]
    assert sum(right) / len(right) > 0.97
    assert all(r["held_out"] == held(i) and 0 <= r["score"] <= 1 for i, r in rows.items())
    odd = [(None if r[0] is None else r[0] + 9000, r[1]) for r in odd_rows]
    found = [r for r in hyper_langid.identified_documents(documents(corpus[0] + odd)).collect() if r["doc_id"] is None or r["doc_id"] > 9000]
    assert len(found) == len(odd)
    assert {r["lang_pred"] for r in found if r["doc_id"] in (9001, 9002, 9003)} == {"und"}
    kept = hyper_langid.keep_identified(documents(corpus[0] + odd), hyper_langid.train(documents(corpus[0])))
    assert kept.count() == len(corpus[0]) + len(odd) - 3 and kept.columns == documents([]).columns


def test_nothing_to_learn_from(documents):
    assert [r["lang_pred"] for r in hyper_langid.identified_documents(documents([(1, "abc", None)])).collect()] == ["und"]
    assert hyper_langid.identified_documents(documents([])).count() == 0


def test_toxicity(documents, labels, corpus, odd_rows):
    odd = [(None if r[0] is None else r[0] + 9000, r[1]) for r in odd_rows]
    rows = {r["doc_id"]: r for r in toxicity.toxic_documents(documents(corpus[0] + odd), labels(corpus[1] + [(9999, 1, None), (None, 1, 1)])).collect()}
    pairs = [(rows[i]["predicted"], t) for i, _, t in corpus[1] if held(i)]
    assert sum(p == t for p, t in pairs) / len(pairs) > 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows.values())
    assert rows[9001]["score"] == rows[9002]["score"] == 0


def test_toxicity_without_labels(documents, labels):
    assert [r["score"] for r in toxicity.toxic_documents(documents([(1, "a")]), labels([])).collect()] == [0.0]
    assert toxicity.toxic_documents(documents([]), labels([])).count() == 0


def test_grades(documents, labels, corpus, odd_rows):
    odd = [(None if r[0] is None else r[0] + 9000, r[1]) for r in odd_rows]
    rows = {r["doc_id"]: r for r in ordinal_quality.graded_documents(documents(corpus[0] + odd), labels(corpus[1])).collect()}
    right = [rows[i]["kept"] == bool(q) for i, q, _ in corpus[1] if held(i)]
    assert sum(right) / len(right) > 0.95
    mean = lambda test: sum(v := [rows[i]["expected_grade"] for i, q, t in corpus[1] if held(i) and test(q, t)]) / len(v)
    assert mean(lambda q, t: not q) < mean(lambda q, t: q and t) < mean(lambda q, t: q and not t)
    assert ordinal_quality.graded_documents(documents([]), labels([])).count() == 0


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def base(text):
    own = words(text)
    windows = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return (len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit), len(own) < 50 or 100 * len(hit) > 50 * len(own))


def test_quality_rules(documents, labels, corpus, odd_rows):
    rng = random.Random(8)
    texts = [(5000 + i, "\n".join(" ".join(rng.choices(["a", "bé", "c#", "D|"], k=rng.randint(0, 6))) for _ in range(rng.randint(0, 12)))) for i in range(60)]
    odd = [(None if r[0] is None else r[0] + 9000, r[1]) for r in odd_rows if r[0] != 4]
    every = corpus[0] + texts + odd
    found = quality_rules.quality_verdicts(documents(every), labels(corpus[1])).collect()
    mine = sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in found), key=repr)
    assert mine == sorted(((r[0], *base(r[1])) for r in every), key=repr)
    rows = {r["doc_id"]: r for r in found}
    right = [rows[i]["kept"] == bool(q) for i, q, _ in corpus[1]]
    assert sum(right) / len(right) > 0.95
    assert not any(r["kept"] and r["base_failed"] for r in found)
    assert quality_rules.quality_verdicts(documents([]), labels([])).count() == 0


def test_last_text_of_a_group_has_a_closing_boundary():
    from holdfast.llm import hyper_langid

    for last in ("a", "!a", "word"):
        codes, owner, _ = hyper_langid.ngram_codes([last, "x y", last])
        assert codes[owner == 0].tolist() == codes[owner == 2].tolist() != []


def test_toxicity_margins_against_brute_force():
    """Window by window; unseen letters beyond ASCII count as letters, and clean words around a text change nothing."""
    rng = np.random.default_rng(2)
    model = toxicity.ToxicityModel(rng.normal(size=(toxicity.BUCKETS, 3)), rng.normal(size=(3, 2)), np.array([0.5, -0.5]))

    def of_word(word):
        slots, n = toxicity.subwords([word])
        assert n[0] == len(slots) == max(sum(max(len(word.decode()) + 2 - k + 1, 0) for k in range(toxicity.SHORTEST, toxicity.LONGEST + 1)), 0)
        return float(model.per_gram[slots].mean()) if len(slots) else 0.0

    def brute(text):
        words = re.findall("[0-9a-z\x80-\U0010ffff]+", text.lower())
        values = [of_word(w.encode()) for w in words]
        return max((sum(values[i : i + toxicity.WINDOW]) / len(values[i : i + toxicity.WINDOW]) + model.bias for i in range(0, len(values), toxicity.WINDOW)), default=-np.inf)

    texts = ["", "a", "One two, THREE four five", "déjà vu größer a-b", "word " * 41, "日本語 テスト x"]
    assert model.margins([t.encode() for t in texts]) == pytest.approx([brute(t) for t in texts], rel=1e-5)
    assert model.margins([b"x y z w " * 10])[0] == pytest.approx(model.margins([b"x y z w " * 5000])[0], rel=1e-6)


def test_long_texts_are_scored_in_parts():
    text = b"clean words here " * 100 + b"and then some others " * 100
    owner, parts = toxicity.parts_of([b"short", text, b""], most=500)
    assert owner[0] == 0 and owner[-1] == 2 and parts[0] == b"short" and len(parts) > 5
    assert all(len(p) <= 500 + 2 * toxicity.OVERLAP for p in parts)
    words = text.split()
    found = [p.split() for o, p in zip(owner, parts) if o == 1]
    assert all(w in words for p in found for w in p)
    pairs = {pair for p in found for pair in zip(p, p[1:])}
    assert pairs == set(zip(words, words[1:]))


def test_language_vectors_against_brute_force():
    """n-gram by n-gram, over scripts whose letters are many, in a table of codes or sorted."""
    texts = ["Ab c", "ÄÖ ß-ß", "日本語テスト", "привет мир", "", "a", "1 2", "x\ny"]

    def vector(text):
        own = np.zeros(hyper_langid.DIMENSIONS)
        line = [0, *(ord(c) if c.isalpha() else 0 for c in text.lower()), 0]
        line = [c for i, c in enumerate(line) if c or not i or line[i - 1]]
        for i in range(len(line) - 2):
            if line[i + 1]:
                parts = hyper_langid.letter_vectors(np.array(line[i : i + 3]))
                own += np.prod([np.roll(v, 2 - k) for k, v in enumerate(parts)], axis=0)
        return own

    for table in (hyper_langid.TABLE, 8):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(hyper_langid, "TABLE", table)
            codes, counts, alphabet = hyper_langid.group_counts(texts)
        assert counts @ hyper_langid.bound(codes, alphabet) == pytest.approx(np.array([vector(t) for t in texts]))
    letters = hyper_langid.letter_vectors(np.arange(0x400, 0x460))
    assert abs(letters.astype(int) @ letters.T.astype(int) - 1024 * np.eye(96)).max() < 200


def test_prototypes_do_not_depend_on_partitions(documents, corpus):
    profiles = [hyper_langid.train(documents(corpus[0]).repartition(n)) for n in (1, 7)]
    assert (profiles[0].prototypes == profiles[1].prototypes).all() and profiles[0].languages == profiles[1].languages
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(hyper_langid, "HELD_GRAMS", 50)
        assert hyper_langid.train(documents(corpus[0])).prototypes == pytest.approx(profiles[0].prototypes, abs=1e-6)


def test_scores_of_hashed_texts_against_brute_force():
    """Kind by kind; the piece that is looked at together changes nothing."""
    from holdfast.llm import hashed_text as ht

    texts = ["", None, "a", "ab c", "one two two three é", "x y " * 300]
    weights = np.random.default_rng(3).normal(size=ht.SIZE)

    def mean(slots):
        return ht.SCALE * float(np.mean(weights[slots])) if len(slots) else 0.0

    def brute(text):
        words = [w.encode() for w in re.findall("[^\x20\x09-\x0d]+", text or "")]
        name = lambda w: zlib.crc32(w) | len(w) << 32
        pairs = [0 if a == b else (name(a) * 0x100000001B3 + name(b)) % 2**64 for a, b in zip(words, words[1:])]
        total = mean(ht.mixed(np.array([name(w) for w in words], np.uint64), 1)) + mean(ht.mixed(np.array(pairs, np.uint64), 2))
        data = (text or "").encode() + b"\n\n\n"
        for width in ht.BYTES:
            codes = [int.from_bytes(data[i : i + width], "little") for i in range(len(data) - 3)]
            # a text's last n-grams run into what follows it
            total += ht.SCALE * float(sum(weights[ht.mixed(np.array([c], np.uint64), width)[0]] for c in codes if c is not None)) / max(len(codes), 1)
        return total

    for piece in (7, 1 << 20):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(ht, "PIECE", piece)
            parts = ht.Parts(pa.array(texts))
            assert parts.score(weights, 0.0) == pytest.approx([brute(t) for t in texts])
    dense = [np.bincount(s, v, ht.SIZE) @ weights for s, v in parts.rows()]
    assert dense == pytest.approx([brute(t) for t in texts], rel=1e-5)


def test_verdicts_of_quality_and_grades_against_brute_force(documents, labels, corpus):
    """The fixed thresholds over the models' own scores, row by row."""
    from holdfast.llm import hashed_text as ht

    docs, marks = documents(corpus[0]), labels(corpus[1])
    model = quality_rules.train(docs, marks)
    rows = {r["doc_id"]: r for r in quality_rules.apply_rules(docs, model).collect()}
    for i, text, _ in corpus[0][:40]:
        parts = ht.Parts(pa.array([text]))
        chance = float(model.probability(parts)[0])
        assert rows[i]["quality_prob"] == pytest.approx(chance, rel=1e-5)
        assert rows[i]["kept"] == (not rows[i]["base_failed"] and rows[i]["quality_prob"] >= quality_rules.THRESHOLD)
    graded = ordinal_quality.graded_documents(docs, marks).collect()
    assert all(r[c] is not None for r in graded[:40] for c in r.__fields__)
