"""Secret spans next to the plain patterns, and the ownership counts."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from tallyvein.llm.queries import op9_secret_scans
from tallyvein.llm.secrets import redact, secret_report, secret_spans

PATTERNS = [
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, re.I | re.A),
    ("access", r"AKIA[A-Z0-9]+", 20, 0, 0),
    ("hex", r"[0-9a-f]+", 24, 0, 0),
]


def brute(text):
    found = []
    for k, (kind, pattern, least, group, flags) in enumerate(PATTERNS):
        found += [(m.start(), k, kind, m.end()) for m in re.finditer(pattern, text or "", flags) if len(m[group]) >= least]
    return [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found)]


def check(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x.startswith(k) for x in base) for k, *_ in PATTERNS]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if not s.startswith("token")] == base


def test_random_texts(spark):
    rng = random.Random(4)
    bits = ["password", "API_key", "apikey", "toKen", '"', "'", " ", "  ", ":", "=", "AKIA", "ABCDEFGH12345678", "deadbeef0123", "é", "ſecret", "\n", "x9", "/", "A", "0f" * 13]
    texts = {i: "".join(rng.choices(bits, k=rng.randrange(40))) for i in range(600)} | {1000: None, 1001: ""}
    docs = spark.createDataFrame([(i, t, "s") for i, t in texts.items()], "doc_id long, text string, spans string")
    check(secret_report(docs).collect(), texts)


def test_tables(spark, data):
    docs = spark.read.parquet(f"{data}/../sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = secret_report(docs, "doc_id", "text", F.col("doc_id"), F.col("source")).collect()
    check(rows, texts)
    assert sum(r.n_assign + r.n_access + r.n_hex for r in rows) > 0


def test_owners_decide(spark):
    copied, live = "password = examplevalue1", "password = onlymine77"
    rare = "key Zx81Qw72Er63Ty54Ui45Op36"
    rows = [(i, copied, f"o{i}") for i in range(4)] + [(10, f"é {live} {copied}", "o1"), (11, rare, "o1"), (12, rare + "z", "o1"), (13, rare + "z", "o2")]
    rows += [(20, None, None), (21, "", "o1"), (22, live * 1, None), (10, f"é {live} {copied}", "o1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, owner string")
    report = secret_report(docs, "doc_id", "text", F.col("doc_id"), F.col("owner")).collect()
    got = {r.doc_id: (r.n_assign, r.spans.count("token:"), r.n_live) for r in report}
    assert len(report) == len(rows)
    assert got == {0: (1, 0, 0), 1: (1, 0, 0), 2: (1, 0, 0), 3: (1, 0, 0), 10: (2, 0, 1), 11: (0, 1, 1), 12: (0, 0, 0), 13: (0, 0, 0), 20: (0, 0, 0), 21: (0, 0, 0), 22: (1, 0, 1)}
    clean = {r.doc_id: r.text for r in redact(docs, "doc_id", "text", F.col("doc_id"), F.col("owner")).collect()}
    assert clean[0] == copied and clean[10] == f"é [secret] {copied}" and clean[11] == "key [secret]" and clean[20] is None and clean[22] == "[secret]"
    assert secret_spans(docs.limit(0)).count() == 0


def test_long_text(spark):
    text = "word " * 200_000 + "AKIA" + "A" * 16 + " end"
    docs = spark.createDataFrame([(1, text), (2, "f" * 500_000)], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secret_report(docs).collect()}
    assert got == {1: "access:1000000:1000020", 2: "hex:0:500000"}


def test_token_of_two_owners_is_live(spark, tmp_path):
    twice, often = "Zx81Qw72Er63Ty54Ui45Op36", "Ab12Cd34Ef56Gh78Ij90Kl21"
    rows = [(1, f"key {twice} end", "o1"), (2, f"key {twice}", "o2")] + [(10 + i, f"key {often}", f"o{i}") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    owned = docs, "doc_id", "text", F.col("doc_id"), F.col("source")
    spans = {r.id: [(s.start, s.end, s.kind, s.owners, s.live) for s in r.spans] for r in secret_spans(*owned).collect()}
    live = [(4, 28, "token", 2, True)]
    assert spans == {1: live, 2: live, 10: [], 11: [], 12: []}
    assert {r.doc_id: r.text for r in redact(*owned).collect()} == {1: "key [secret] end", 2: "key [secret]"} | {10 + i: f"key {often}" for i in range(3)}
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.spans, r.n_live) for r in op9_secret_scans(spark, str(tmp_path)).collect()}
    assert got == {1: ("token:4:28", 1), 2: ("token:4:28", 1), 10: ("", 0), 11: ("", 0), 12: ("", 0)}


def test_redact_keeps_columns_of_any_name(spark):
    names = ["_text", "_id", "_spans", "_done", "_hash", "_text_hash", "__text", "spans"]
    rows = [(i, 'password = "hunter2secret%d"' % i, *names) for i in range(3)] + [(9, None, *names), (10, "", *names)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    out = redact(df, "doc_id", "text", F.col("doc_id"), F.col("doc_id"))
    assert out.columns == df.columns
    got = {r[0]: tuple(r)[1:] for r in out.collect()}
    assert all("[secret]" in got[i][0] and "hunter2" not in got[i][0] for i in range(3)) and got[9][0] is None and got[10][0] == ""
    assert all(v[1:] == tuple(names) for v in got.values())
    assert redact(df.limit(0)).collect() == []
