"""Personal data and secrets: base spans against the plain patterns, and what the methods add."""

import random
import re

from issuelab.llm import pii, secret_scan
from issuelab.llm.spans import code_point_places

from .awkward import awkward_docs, empty_docs, with_clashes

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def _digits(text):
    return re.sub("[^0-9]", "", text)


def plain_pii(text):
    keep = {
        "email": lambda s: True,
        "ip": lambda s: all(int(p) <= 255 for p in s.split(".")),
        "card": lambda s: 13 <= len(_digits(s)) <= 19 and pii._luhn(_digits(s)),
        "phone": lambda s: 9 <= len(_digits(s)) <= 15,
    }
    return [(k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if keep[k](m.group())]


def plain_secrets(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text, re.I | re.A) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24])


def test_base_spans_match_the_plain_patterns():
    rng = random.Random(1)
    one = ["a", "B", "@", ".", "-", "1", "23", "255", "4111111111111111", " ", "+", "(", "é", "_", "%", "9 ", "0."]
    two = ["secre", "token", "API_key", "Passw", "ord", "passwd", "=", ":", "'", '"', " ", "ab12", "é", "K", "AKIA"]
    two += ["ZZ9", "deadbeef00", "x"]
    for _ in range(6000):
        text = "".join(rng.choice(one) for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == plain_pii(text)
        text = "".join(rng.choice(two) for _ in range(rng.randint(0, 30)))
        raw = text.encode()
        spans = secret_scan.base_spans(raw)
        place = code_point_places(raw, [p for a, _, b in spans for p in (a, b)])
        assert [(place[a], k, place[b]) for a, k, b in spans] == plain_secrets(text)


def test_long_runs_take_linear_time():
    for unit in ("1", "a", "1.", "+", "+1 ", "@", "a@", "password ", "f", "A"):
        text = unit * (400_000 // len(unit))
        pii.base_spans(text)
        secret_scan.base_spans(text.encode())


def test_terms_that_give_an_entity_away(spark):
    docs = [(i, f"text number {i} about common things and people everywhere", "x") for i in range(60)]
    docs += [(100 + i, "please write to jane@example.org the zanzibarian about common things", "x") for i in range(4)]
    docs += [(200, "only once: rare@example.org knows the quirkword", "x"), (201, None, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, added string")
    rows = {r["doc_id"]: r for r in pii.with_spans(df).collect()}
    text = docs[60][1]
    told = {(s["kind"], text[s["start"] : s["end"]]) for s in rows[100]["spans"]}
    assert ("email", "jane@example.org") in told and ("removed", "zanzibarian") in told
    assert not any("common" in t for _, t in told)
    assert [s["kind"] for s in rows[200]["spans"]] == ["email"]  # no estimate from one document
    assert rows[0]["spans"] == [] and rows[201]["spans"] == []
    clean = {r["doc_id"]: r for r in pii.sanitise(df).collect()}
    assert "jane" not in clean[100]["text"] and "zanzibarian" not in clean[100]["text"] and "<EMAIL>" in clean[100]["text"]
    assert clean[0]["text"] == docs[0][1] and clean[201]["text"] is None and clean[0]["added"] == "x"


def test_overlapping_spans_are_replaced_once():
    spans = [{"kind": "card", "start": 2, "end": 8}, {"kind": "phone", "start": 1, "end": 5}]
    assert pii._rewrite("a+123456789", spans) == "a<PHONE>789"


def test_strings_that_do_not_compress_are_reported(spark):
    prose = "the settings of the client and the server " * 3
    key = "qZ7xV2mK9pL4wT8rB3nY6sD1"
    docs = [(1, f"{prose} auth {key} end é"), (2, f"{prose} auth settings_client_server_settings end"), (3, None)]
    docs += [(10 + i, prose) for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = {r["doc_id"]: r for r in secret_scan.with_spans(df).collect()}
    (span,) = rows[1]["spans"]
    assert (span["kind"], docs[0][1][span["start"] : span["end"]]) == ("novel", key)
    assert rows[2]["spans"] == [] and rows[3]["spans"] == [] and rows[1]["base"] == []


def test_awkward_tables(spark):
    for found in (pii.with_spans, secret_scan.with_spans):
        docs = with_clashes(awkward_docs(spark))
        got = found(docs)
        assert got.count() == docs.count() and set(docs.columns) <= set(got.columns)
        assert found(empty_docs(spark)).count() == 0
    assert pii.sanitise(awkward_docs(spark)).columns == awkward_docs(spark).columns


def test_every_candidate_near_a_sensitive_word_is_measured():
    meter, rules = secret_scan._Meter(" ".join([*secret_scan.CODE_WORDS, "production", "tokens"]).encode()), secret_scan.Novelty()
    one, two = "wJalrXUtnFEMIK7MDENGbPxRfiCYzQ8sLd", "qZ7xV2mK9pL4wT8rB3nY6sD1"
    far = " " * 30

    def told(text):
        raw = text.encode()
        return [raw[a:b].decode() for a, b in secret_scan.novel_spans(raw, secret_scan.base_spans(raw), meter, rules)]

    assert told(f'secret_access_key_production = "{one}"') == [one]  # after a name that is itself long
    assert told(f'tokens: ["{two}", "{one}"]') == [two, one]  # more than one
    assert told(f"auth{far}{two}") == [two]  # starts within reach, ends beyond it
    assert told(f"{two} is the credential") == [two]  # before the word
    assert told(f"private_key={one}==") == [f"{one}=="] and told(f"auth-{two}") == [f"auth-{two}"]
    assert told(f"token={one} and auth {two}") == [two]  # the first one is a base span
    assert told(f"{two} {'x ' * 40} {one}") == [] and told("secret_access_key_production") == []


def test_dense_sensitive_words_take_linear_time():
    meter, rules = secret_scan._Meter(b"key"), secret_scan.Novelty()
    for unit in ("key", "key ", "auth=", "a=", "x", "authentication_of_many_words ", "token=abcdef/"):
        raw = (unit * (400_000 // len(unit))).encode()
        secret_scan.novel_spans(raw, secret_scan.base_spans(raw), meter, rules)


def test_terms_are_counted_and_removed_in_the_whole_text(spark):
    far = " and so on about common things" * 6
    docs = [(i, f"text number {i}{far}") for i in range(60)]
    docs += [(100 + i, f"jane@example.org the zanzibarian{far} Zanzibarian{far}, zanzibarian") for i in range(4)]
    docs += [(200, f"joe@example.org the quirkword{far}")]  # near once, farther off in the others
    docs += [(201 + i, f"joe@example.org{far} quirkword {i}") for i in range(4)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for r in pii.with_spans(df).collect():
        told = [r["text"][s["start"] : s["end"]].lower() for s in r["spans"] if s["kind"] == "removed"]
        want = ["zanzibarian"] * 3 if 100 <= r["doc_id"] < 200 else ["quirkword"] * (r["doc_id"] >= 200)
        assert [t for t in told if t in ("zanzibarian", "quirkword")] == want and "common" not in told
    assert not any("zanzibarian" in r["text"].lower() or "quirkword" in r["text"] for r in pii.sanitise(df).collect())


def test_places_outside_base_spans():
    text = "jane jane@example.org +49 170 1234567 jane, JANE janet"
    got = pii.occurrences(text, {"jane": "removed", "170": "general"})
    assert [(k, text[a:b]) for k, a, b in got] == [("removed", "jane"), ("removed", "jane"), ("removed", "JANE")]
