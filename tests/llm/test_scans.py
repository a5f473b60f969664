"""Secret scan, PII and URL filter against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re

import pytest

from clickloom.llm import pii, secrets, urls

DOCS = "doc_id long, text string, spans string, base string, size int"


def docs(spark, texts, schema="doc_id long, text string, spans string, base string, size int"):
    """With columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in enumerate(texts)], schema)


def sha(spans):
    return hashlib.sha256(",".join(spans).encode()).hexdigest()


# ---------------------------------------------------------------- secrets

ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain_secrets(t):
    t = t or ""
    found = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    return [x[2] for x in sorted(found)]


def test_secrets_base_is_the_plain_patterns(spark):
    r = random.Random(2)
    parts = ["password", "TOKEN", "api_key", "apikey", "secret", " ", "=", ":", '"', "'", "AKIA", "A1B2C3D4E5F6G7H8", "deadbeef" * 3, "ab12", "\n", "é", "😀", "x" * 7, "token=secret:abcdefg"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(12))) for _ in range(1500)] + [None, "", "secret:token:abcdefg", "a" * 50_000, "token = " + "f" * 30_000, "key: " * 5000]
    got = {x["doc_id"]: x for x in secrets.find_secrets(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        want = plain_secrets(t)
        assert got[i]["base_sha256"] == sha(want), t
        assert set(want) <= set(got[i]["spans"].split(",")) | ({""} if not want else set())
        assert (got[i]["n_assign"], got[i]["n_access"], got[i]["n_hex"]) == tuple(sum(w.startswith(k) for w in want) for k in ("assign", "access", "hex"))


def literals(text):
    return [text[s:e] for s, e, k in secrets.all_spans(text, secrets.Scan())[1] if k == "literal"]


def test_secrets_lexing():
    assert literals('db_passphrase = "correcthorse"') == ["correcthorse"]
    assert literals('x = "s3cr3tValue99"\nclientSecret: x\n') == ["s3cr3tValue99"]  # a constant reaches a sensitive name
    assert literals('a = "q1w2e3r4t5"\nb = a\nAUTH_TOKEN = b') == ["q1w2e3r4t5"]
    assert literals("{'privateKey': 'abc123' + 'def456'}") == ["abc123", "def456"]
    assert literals('password_policy = "at least eight"\ntitle: "a nice day"\npublic_key_url = "https://x.y/z"') == []
    assert literals('secret = "changeme"') == [] and literals("Note: the token expires") == []
    text = 'x = "s3cr3tValue99"\npwd = x\npassword="hunter2hunter2"'
    assert secrets.redacted(text, secrets.all_spans(text, secrets.Scan())[1]) == 'x = "<secret>"\npwd = x\n<secret>"'


def test_secrets_lexing_of_long_strings():
    assert literals('private_key = """\nMIIEvQIBADANBg\n  kqhkiG9w0BAQEF\n"""\nnote = 1') == ["MIIEvQIBADANBg", "kqhkiG9w0BAQEF"]
    assert literals("auth_token: |\n  abcDEF123456\n  ghiJKL789012\nname: fine-value\n") == ["abcDEF123456", "ghiJKL789012"]
    assert literals("  signing_key: >-\n    abcDEF123456\n  label: ghiJKL789012\n") == ["abcDEF123456"]
    assert literals('doc = """\nit is about a long\nstory\n"""') == []


def test_secrets_constants_pass_any_number_of_names():
    chain = "".join(f"n{i} = n{i + 1}\n" for i in range(40)) + 'n40 = "q1w2e3r4t5"\nclient_secret = n0\n'
    assert literals(chain) == ["q1w2e3r4t5"]
    assert literals("a = b\nb = a\nclient_secret = a\n") == []  # a circle has no literal longer than a name
    long = 'k0 = "q1w2e3r4t5"\n' + "".join(f"k{i + 1} = k{i}\n" for i in range(20_000)) + "client_secret = k20000\n"
    assert literals(long) == ["q1w2e3r4t5"]


def test_secrets_literals_by_a_plain_interpreter():
    """Names that are assigned once each, in any order and through each other, and sensitive names that use them."""
    r = random.Random(17)
    scan = secrets.Scan()
    values = ["q1w2e3r4t5", "correcthorse", "ab", "changeme", "two words", "aaaaaaaa", "Zx9-Yw8_Vu7", "${HOME}"]
    found = 0
    for _ in range(500):
        names = [f"v{i}" for i in range(r.randrange(1, 8))]
        text, known, want = "", {}, set()

        def literal(name):
            """The place of the literal that a name stands for by now; None for a name that nobody assigned, and for circles."""
            seen = set()
            while isinstance(known.get(name), str) and name not in seen:
                seen.add(name)
                name = known[name]
            return known.get(name) if isinstance(known.get(name), tuple) else None

        for name in [*r.sample(names, len(names)), *r.choices(["client_secret", "authToken", "title", "API_KEY", "max_tokens_count", "key"], k=6)]:
            sign = r.choice([" = ", ": ", "=", " := ", " => "])
            text += name + sign
            if r.random() < 0.5:
                value = r.choice(values)
                place = (len(text) + 1, len(text) + 1 + len(value))
                text += f'"{value}"'
                known[name] = place
            else:
                known[name] = r.choice(names)
                text += known[name]
                place = literal(name)
            text += r.choice(["\n", "\n", "  # a note\n", "\n\nplain words\n"])
            parts = {p.lower() for p in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+", name)}
            score = sum((secrets.SENSITIVE | secrets.HARMLESS).get(p, 0.0) for p in parts)
            if place and score > 0:
                v = text[slice(*place)]
                counts = [v.count(c) / len(v) for c in set(v)]
                worth = min(0.3, -sum(p * math.log2(p) for p in counts) / 15)
                if len(v) >= 6 and " " not in v and v not in ("changeme", "${HOME}") and score + worth >= scan.threshold:
                    want.add((*place, "literal"))
        assert secrets.lexed_spans(text, scan) == sorted(want), text
        found += len(want)
    assert found > 300


def test_secrets_ids_stay_as_they_are(spark):
    big = 2**53 + 1
    rows = [(big, "token = abcdefgh"), (None, "token = abcdefgh"), (big + 2, None)]
    got = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert sorted(((r["doc_id"] or 0), r["n_assign"]) for r in got) == [(0, 1), (big, 1), (big + 2, 0)]


def test_redaction_keeps_rows(spark):
    d = docs(spark, ["token = abcdefgh", None, "", "fine", "fine"])
    got = sorted(secrets.redact_secrets(d).collect())
    assert [r["text"] for r in got] == ["<secret>", None, "", "fine", "fine"] and got[0]["size"] == 1
    assert secrets.find_secrets(d.limit(0)).collect() == []


# ---------------------------------------------------------------- PII

KINDS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def valid(kind, v):
    d = re.sub("[^0-9]", "", v)
    if kind == "ip":
        return all(int(x) <= 255 for x in v.split("."))
    if kind == "card":
        doubled = [int(c) * 2 if i % 2 else int(c) for i, c in enumerate(reversed(d))]
        return 16 <= len(d) <= 19 and sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0
    return kind == "email" or 8 <= len(d) <= 15


def plain_pii(t):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in KINDS for m in re.finditer(p, t or "") if valid(k, m[0])]


def test_pii_base_is_the_plain_patterns(spark):
    r = random.Random(1)
    parts = ["1", "2", "9", "0", ".", "@", "-", " ", "+", "a", "Z", "_", "(", ")", "4111 1111 1111 1111", "😀", "é", "255", "256", "a@b.co", "\x01", "\n"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(60))) for _ in range(1500)] + [None, "", "a@b.c " * 500 + "1.2.3.4 " * 300, "9" * 20_000, "a" * 100_000 + "@x", "+1" + " " * 5000]
    got = {x["doc_id"]: x for x in pii.digests(pii.find(docs(spark, texts))).collect()}
    for i, t in enumerate(texts):
        want = plain_pii(t)
        assert got[i]["base_sha256"] == sha(want), t
        assert [got[i][f"n_{k}"] for k, _ in KINDS] == [sum(w.startswith(k) for w in want) for k, _ in KINDS]
        assert got[i]["spans"].split(",")[: len(want)] == want or not want
    assert pii.find(docs(spark, ["x"]).limit(0)).collect() == []


def test_pii_ips_with_a_part_of_zeros(spark):
    """A part of zeros keeps its last digit; leading zeros of other parts don't count."""
    texts = ["0.0.0.0", "10.0.0.1", "000.1.2.3", "192.168.0.1 or 127.0.0.1", "1.2.3.00", "010.2.3.4", "0256.0.0.1", "0.0.0.300", "0" * 50_000 + ".0.0.999"]
    got = {x["doc_id"]: x for x in pii.digests(pii.find(docs(spark, texts))).collect()}
    assert [got[i]["n_ip"] for i in range(len(texts))] == [1, 1, 1, 2, 1, 1, 0, 0, 0]
    assert [got[i]["base_sha256"] for i in range(8)] == [sha(plain_pii(t)) for t in texts[:8]]
    assert {x["text"] for x in pii.sanitise(docs(spark, ["at 10.0.0.1"])).collect()} == {"at <ip>"}


def test_pii_disclosing_terms(spark):
    """`zorblatt` is only where the address is, `often` is everywhere; a term seen once has no support."""
    texts = ["Often zorblatt wrote to jane@x.org once", "Often a Zorblatt at jane@x.org again", "solitary word for bob@y.org"] + [f"often there are other words {i}" for i in range(40)] + [None, ""]
    d = docs(spark, texts)
    terms = {x["doc_id"]: [texts[x["doc_id"]][t["start"] : t["end"]] for t in x["terms"]] for x in pii.find(d).collect() if x["terms"]}
    counts = {w: sum(bool(t) and w in set(re.split(r"[^a-z]+", t.lower())) for t in texts) for w in ("zorblatt", "often")}
    n = len(texts)
    share = lambda w: math.log2(2 * n / (2 * counts[w])) / math.log2(n / 2)
    assert share("zorblatt") >= 0.8 > share("often")
    assert terms == {0: ["zorblatt"], 1: ["Zorblatt"]}
    clean = {x["doc_id"]: x["text"] for x in pii.sanitise(d).collect()}
    assert clean[0] == "Often  wrote to <email> once" and clean[1] == "Often a <name> at <email> again" and clean[43] is None and clean[44] == ""


def test_pii_terms_by_brute_force(spark):
    """Disclosure of every term of every document, from plain counts."""
    r = random.Random(23)
    people = [(f"name{'abcdefgh'[i]}", [f"p{i}@x.org", f"P{i}@x.org", f"+1 555 000 1{i}", f"10.0.0.{i}"]) for i in range(8)]
    texts: list[str | None] = [None, ""]
    for _ in range(300):
        words = r.choices(["often", "there", "words", "some", "a", "of"], k=6)
        if r.random() < 0.4:
            name, marks = r.choice(people)
            words += [r.choice([name, name.title(), "common"]), *r.choices(marks, k=r.randrange(1, 3)), r.choice([name, "rare", "org"])]
        r.shuffle(words)
        texts.append(" ".join(words))
    n, how = len(texts), pii.Sanitise()
    terms, held, in_docs = [], [], {}
    for t in texts:
        base = [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in plain_pii(t))]
        value = lambda k, a, b: re.sub("[^0-9]", "", t[a:b]) if k in ("card", "phone") else t[a:b].lower()
        held.append({(k, value(k, a, b)) for k, a, b in base})
        terms.append([m for m in re.finditer("[A-Za-z]{3,}", t or "") if base and all(m.end() <= a or b <= m.start() for _, a, b in base)])
        for w in set(re.findall("[a-z]{3,}", (t or "").lower())):
            in_docs[w] = in_docs.get(w, 0) + 1
    entities = {e for h in held for e in h}
    hits = set()
    for e in entities:
        mine = [i for i in range(n) if e in held[i]]
        both: dict[str, int] = {}
        for i in mine:
            for w in {m[0].lower() for m in terms[i]}:
                both[w] = both.get(w, 0) + 1
        for w, k in both.items():
            if k >= how.support and len(mine) >= how.support and in_docs[w] >= how.support:
                share = math.log2(k * n / (len(mine) * in_docs[w])) / math.log2(n / len(mine))
                assert abs(share - how.disclosure) > 1e-9
                hits |= {(e, w)} if share >= how.disclosure else set()
    want = {i: sorted(m.span() for m in terms[i] if any((e, m[0].lower()) in hits for e in held[i])) for i in range(n)}
    got = {x["doc_id"]: [tuple(t) for t in x["terms"]] for x in pii.find(docs(spark, texts)).collect()}
    assert got == want and sum(map(bool, want.values())) > 10 and len({w for _, w in hits}) > 2


def test_pii_terms_of_the_whole_document(spark):
    """A name far from the address discloses it, and goes wherever it stands in the document."""
    far = " often" * 60
    texts = [f"Zorblatt writes{far} jane@x.org{far} zorblatt", f"Dear Zorblatt{far} jane@x.org", "writes"] + [f"often writes {i}" for i in range(40)]
    got = {x["doc_id"]: [texts[x["doc_id"]][t["start"] : t["end"]] for t in x["terms"]] for x in pii.find(docs(spark, texts)).collect() if x["terms"]}
    assert got == {0: ["Zorblatt", "zorblatt"], 1: ["Zorblatt"]}


def test_pii_counts_rows(spark):
    """Rows that repeat count in every number alike: a pair of rows is support enough, and the share is that of rows."""
    texts = ["zorblatt jane@x.org"] * 2 + [f"often there are other words {i}" for i in range(40)]
    d = spark.createDataFrame([(min(i, 1), t) for i, t in enumerate(texts[:1] * 2)] + [(i, t) for i, t in enumerate(texts[2:], 2)], "doc_id long, text string")
    one_id = spark.createDataFrame([(0, texts[0]), (0, texts[0]), *enumerate(texts[2:], 2)], "doc_id long, text string")
    for df in (d, one_id):
        assert [[t["start"] for t in x["terms"]] for x in pii.find(df).collect() if x["terms"]] == [[0], [0]]


def test_pii_columns_stay_as_they_are(spark):
    d = spark.createDataFrame([(1, "a@b.co", "x", 5, "y"), (None, "fine", "z", 6, "w")], "doc_id long, text string, digest string, _digest int, base string")
    got = sorted(map(tuple, pii.sanitise(d).collect()), key=str)
    assert got == sorted([(1, "<email>", "x", 5, "y"), (None, "fine", "z", 6, "w")], key=str)


def test_pii_dotted_numbers_by_brute_force(spark):
    """Runs of dotted numbers, dense in zeros and leading zeros."""
    r = random.Random(8)
    part = lambda: r.choice(["0", "00", "000", "01", "1", "10", "99", "100", "199", "249", "255", "256", "300", "0255", "0256", "1000"])
    texts = ["".join(part() + r.choice([*"........", "..", " ", "-", "@", ""]) for _ in range(r.randrange(3, 14))) for _ in range(4000)]
    got = {x["doc_id"]: x for x in pii.digests(pii.find(docs(spark, texts))).collect()}
    assert [i for i, t in enumerate(texts) if got[i]["base_sha256"] != sha(plain_pii(t))] == []
    assert sum(x["n_ip"] for x in got.values()) > 500


def test_pii_repeated_rows_and_ids(spark):
    d = spark.createDataFrame([(1, "a@b.co"), (1, "a@b.co"), (1, "x"), (None, "1.2.3.4"), (None, None)], "doc_id long, text string")
    got = sorted((x["doc_id"] or 0, x["spans"]) for x in pii.digests(pii.find(d)).collect())
    assert got == [(0, ""), (0, "ip:0:7"), (1, ""), (1, "email:0:6"), (1, "email:0:6")]


# ---------------------------------------------------------------- URLs


def plain_url(u):
    host = path = ""
    if u and "://" in u:
        rest = u.split("://", 1)[1]
        k = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:k])
        path = re.split(r"[?#]", rest[k:], maxsplit=1)[0]
    fits = [r for r in urls.RULES if (h := r[1].split("/", 1)[0]) and (host == h or host.endswith("." + h)) and path.startswith("/" + r[1].split("/", 1)[1])]
    best = max(fits, key=lambda r: len(r[1]), default=None)
    return host, path, best and best[1], best and best[0]


def test_urls(spark):
    given = [None, "", "x", "http://", "http://A.Example.NET/en/1?q=://z", "https://example.net/en", "https://net/", "https://planet/", "http://a.org/fr/x#y", "http://b.example.com/de/1", "http://example.com", "a://b?c://d/e",
             "http://x.io/cheap-pills", "http://x.io/cheap", "http://essex.io/sexy", "http://x.io/PORN/", "http://cheap.io/a/cheap", "http://x.io/" + "a" * 100_000, "http://x.io/ü/é"]
    rows = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(given)], "page_id long, url string, host string, rule string")
    got = {x["page_id"]: x for x in urls.filter_urls(rows).collect()}
    for i, u in enumerate(given):
        host, path, rule, verdict = plain_url(u)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert verdict in (None, got[i]["verdict"])
    blocked = {given[i] for i, x in got.items() if x["rule"] is None and x["verdict"] == "block"}
    assert blocked == {"http://x.io/cheap-pills", "http://x.io/PORN/"}
    assert urls.filter_urls(rows.limit(0)).collect() == []


@pytest.mark.parametrize("text", ["", "a", "aXXXb", "xxx", "free bet", "free free", "a-free-winner"])
def test_vocabulary_boundaries(text):
    v = urls.Vocabulary()
    (strict, soft, rejected), = urls.judge([text], v, v.automaton())
    words = re.findall(r"[^\W_]+", text.lower())
    want = sum(w in v.strict for w in words), len({w for w in words if w in v.soft})
    assert (strict, soft) == want and rejected == (want[0] > 0 or want[1] > 1)


def test_vocabulary_from_a_table_and_percent_signs(spark):
    t = spark.createDataFrame([("Foo", None), ("bar", 1.5), ("baz", 0.5), ("baz", 0.25), ("qux", 0.4), (None, None), ("", None), ("foo", 0.1)], "term string, weight double")
    v = urls.Vocabulary.from_table(t)
    assert v.strict == ("foo",) and v.soft == (("bar", 1.5), ("baz", 0.5), ("qux", 0.4))
    given = ["http://a/%66oo", "http://a/b%61r-baz", "http://a/bar-qux", "http://a/bar-bar", "http://a/%zz%e9-foo%20", "http://a/f%6Fod", "http://a/%2566oo"]
    assert [r for _, _, r in urls.judge(given, v, v.automaton())] == [True, True, False, False, True, False, False]
    with pytest.raises(ValueError):
        urls.Vocabulary.from_table(t, most=2)
    empty = urls.Vocabulary((), ())
    assert list(urls.judge(["x"], empty, empty.automaton())) == [(0, 0, False)]
