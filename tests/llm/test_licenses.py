import random
import re

from entiledger.llm import licenses, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG_MIT = next(t for label, t in licenses.TEMPLATES if label == "mit" and len(t) > 100)


def plain_words(text):
    return WORD.findall((text or "").translate(UPPER))


def plain_places(text, phrases):
    words = plain_words(text)
    return [
        (i, label)
        for i in range(len(words))
        for phrase, label in sorted(phrases, key=lambda p: p[1])
        if words[i : i + len(phrase.split())] == phrase.split()
    ]


TEXTS = [
    None, "", "...", "CC-BY cc by CC  BY\nNC", "All rights\nRESERVED. all rights reserved",
    "general public licenses general public license", "cc bÿ ÀCC by", "x" * 3_000_000,
    "all rights reserved " * 60_000, "Released under the MIT License", LONG_MIT, LONG_MIT.upper() + " all rights reserved",
    LONG_MIT.replace("free of charge", "without any kind of cost"), LONG_MIT[:200],
    f"{LONG_MIT} {'word ' * 50} {LONG_MIT}", "the software of the software is the software",
]


def test_words_in_pieces():
    rng = random.Random(2)
    text = "".join(rng.choices("aZ9 .é日\U0001f600\n", k=200_000))
    whole = plain_words(text)
    before = licenses._PIECE
    try:
        for size in (1, 7, 1000, before):
            licenses._PIECE = size
            got = [w.decode() for part in licenses.words(text[:5000]) for w in part]
            assert got == plain_words(text[:5000])
    finally:
        licenses._PIECE = before
    assert [w.decode() for part in licenses.words(text) for w in part] == whole


def test_matching_statistics_against_all_runs():
    phrases = [("a b", "x"), ("b a b", "y"), ("a b", "z")]
    templates = [("t", "a b c a b d a b"), ("u", "b c a a b"), ("t", "a b c"), ("u", "a b c")]
    machine = licenses.Automaton(phrases, templates)
    runs = [text.split() for text, _ in phrases] + [text.split() for _, text in templates]
    known = {tuple(r[i:j]) for r in runs for i in range(len(r)) for j in range(i + 1, len(r) + 1)}
    rng = random.Random(3)
    for _ in range(500):
        words = rng.choices("abcde", k=rng.randrange(0, 15))
        text, seen = " ".join(words), [0]
        told = {p: (n, s) for p, n, s in licenses.statistics(machine, text, seen)}
        assert seen == [len(words)]
        for i in range(1, len(words) + 1):
            want = max(k for k in range(i + 1) if k == 0 or tuple(words[i - k : i]) in known)
            length, state = told.get(i, (0, 0))
            assert length == want
            if want:
                there = [
                    (n, e)
                    for n, r in enumerate(runs)
                    for e in range(want, len(r) + 1)
                    if r[e - want : e] == words[i - want : i]
                ]
                assert sorted(machine.places[state]) == there
        places = [(p["start"], p["label"]) for p in licenses.found(machine, text)["places"]]
        assert places == plain_places(text, phrases)


def test_spans():
    machine = licenses.Automaton()

    def spans(text):
        return [(s["label"], s["start"], s["end"]) for s in licenses.found(machine, text)["spans"]]

    size = len(plain_words(LONG_MIT))
    assert spans(LONG_MIT) == [("mit", 0, size)]
    assert spans(TEXTS[12]) == [("mit", 0, size + 2)]
    assert spans(TEXTS[13]) == []
    assert spans(TEXTS[14]) == [("mit", 0, size), ("mit", size + 50, 2 * size + 50)]
    for label, text in licenses.TEMPLATES:
        assert (label, 0, len(plain_words(text))) in spans(text)
    scores = [licenses.found(machine, t)["score"] for t in TEXTS]
    assert all(0 <= s <= 1 for s in scores)
    assert scores[:3] == [0, 0, 0] and scores[10] > scores[12] > scores[13] > 0


def test_chains_keep_order_and_count_overlaps_once():
    assert max(licenses.chained([(0, 4, 0), (4, 4, 4)])) == (8, 0, 8)
    assert max(licenses.chained([(0, 4, 4), (4, 4, 0)]))[0] == 4
    assert max(licenses.chained([(0, 5, 0), (3, 5, 4)])) == (8, 0, 8)
    assert max(licenses.chained([(0, 4, 0), (4 + licenses.GAP + 1, 4, 4)]))[0] == 4
    assert licenses.chained([]) == []
    assert licenses.apart([(0.8, 0, 10), (1.0, 5, 15), (0.9, 15, 20)]) == [
        (5, 15, 1.0), (15, 20, 0.9),
    ]


def test_query(spark, sf_dir, texts):
    rows = queries.QUERIES["op11_licenses"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        places = plain_places(texts[r.doc_id], licenses.PHRASES)
        assert r.n_words == len(plain_words(texts[r.doc_id]))
        assert r.n_base == len(places)
        assert r.first_word == min((a for a, _ in places), default=None)
        assert r.last_word == max((a for a, _ in places), default=None)
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
        assert 0 <= r.score <= 1 and (r.score > 0.5) >= (r.n_base > 0)
    assert sum(r.n_base for r in rows) > 2


def test_frame(docs_of):
    docs = docs_of([*enumerate(TEXTS), (None, TEXTS[4]), (4, TEXTS[4])])
    done = licenses.scan(docs)
    assert set(done.columns) == {*docs.columns, "licenses"}
    rows = done.collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        places = [(p.start, p.label) for p in r.licenses.places]
        assert places == plain_places(r.text, licenses.PHRASES)
        assert r.licenses.n_words == len(plain_words(r.text))
    assert licenses.scan(docs.limit(0)).count() == 0
