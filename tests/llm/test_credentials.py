"""The secret scan against plain regular expressions."""

import hashlib
import re

from geotracks.llm import credentials

SCHEMA = "doc_id long, text string, source string, kind string, hash int, _row int, end int"
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
FORM = re.compile(credentials.FORMS)
KEY = "AKIA" + "Z9Y8X7W6V5U4T3S2"
HEX = "0123456789abcdef" * 3


def matches(text):
    text = text or ""
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= 8:
            yield "assign", m.start(), m.end(), m[2]
    for kind, pattern, least in (("access", r"AKIA[A-Z0-9]+", 16), ("hex", r"[0-9a-f]+", 32)):
        for m in re.finditer(pattern, text):
            if len(m[0]) >= least:
                yield kind, m.start(), m.end(), m[0]
    for m in FORM.finditer(text):
        yield "form", m.start(), m.end(), m[0]


def live(value):
    hidden = re.search("example|sample|dummy|changeme|placeholder|password|your|xxxx", value, re.I)
    return len(value) >= 12 and re.search("[A-Za-z]", value) and re.search("[0-9]", value) and len(set(value)) >= 6 and not hidden


def expected(rows):
    owners, holders = {}, {}
    for doc, text, source in rows:
        for *_, value in matches(text):
            owners.setdefault(value, set()).add(source)
            holders.setdefault(value, set()).add((source, doc))
    out = []
    for doc, text, _ in rows:
        found = list(matches(text))
        base = {(a, credentials.KINDS.index(k), b, k) for k, a, b, _ in found if k != "form"}
        added = set()
        for _, _, end, value in found:
            if len(owners[value]) >= 5 and len(holders[value]) >= 5:
                added.add((end - len(value), 4, end, "copied"))
            elif len(owners[value]) == 1 and live(value):
                added.add((end - len(value), 3, end, "live"))
        joined = lambda spans: ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))
        counts = [sum(k == kind for *_, k in base) for kind in ("assign", "access", "hex")]
        out.append((doc, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base | added)))
    return sorted(out, key=str)


def test_spans_equal_plain_expressions(spark):
    texts = [
        None, "", "no secret here", "password=hunter2", 'Password" : "hunter2hunter2', "token=secret:abcdefgh12", "token=a secret=b2c3d4e5f6g7",
        f"été 東京 🙂 {KEY} and {KEY}", "AKIA", "AKIAB", "xAKIA" + "Q" * 11 + " AKIA" + "Q" * 12, HEX, HEX[:31], HEX.upper(), f"g{HEX}g", f"api_key={HEX}",
        "apikey='example-key-0001'", "secret==" + "ab1" * 9, "ghp_" + "a1B2c3D4e5F6" * 3, "passwd:token:password:" + "z9" * 8,
        "word " * 50_000 + "password = Zx81Qw72Er63 " + "token: Ab12Cd34Ef56 " * 300, "password=p1\npassword=Tr0ub4dor&3", "ſecret=abcdefgh12 ApI_Key=Kk12345678",
    ]
    rows = [(i, t, ["a", "b", None, "c"][i % 4]) for i, t in enumerate(texts)]
    # an example that a third of the rows holds, in many places, and one owner's key in several rows
    rows += [(100 + i, f"see {KEY} or password=hunter2hunter2", f"s{i % 9}") for i in range(30)]
    rows += [(None, "token=OnlyOne0wner77", None), (None, "token=OnlyOne0wner77", None), (7, texts[7], "a")]
    table = spark.createDataFrame([(*r, "k", 1, 2, 3) for r in rows], SCHEMA).repartition(3)
    got = credentials.scan(table)
    assert got.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)
    assert credentials.scan(table.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    table = spark.createDataFrame([(1, "password=hunter2hunter2", "a", "k", 1, 2, 3)], SCHEMA)
    stored = spark.read.parquet(_written(table))
    plan = credentials.scan(stored)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def _written(table):
    import tempfile

    path = tempfile.mkdtemp(prefix="credentials-") + "/t"
    table.write.parquet(path)
    return path
