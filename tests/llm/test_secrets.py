import hashlib
import re
from dataclasses import replace

from llm_fixtures import SF_CHECK, no_documents, odd_documents  # noqa: F401

from rxcast.llm.queries import QUERIES
from rxcast.llm.secrets import LEDGER, RULES, scan_versions
from rxcast.llm.tables import shared_path

KEYWORDS = "password|passwd|secret|token|api_?key"
GIVEN = {"assign": (re.compile("(" + "".join(f"[{c}{c.upper()}]" if c.islower() else c for c in KEYWORDS)
                               + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
         "access": (re.compile("AKIA[A-Z0-9]+"), 0, 20), "hex": (re.compile("[0-9a-f]+"), 0, 24)}
TEXTS = ["secret:token:abcdefgh", "SECRET = 'abcdef' Token\"=\"a.b/c+d", "paſsword=abcdefgh toKen=abcdefgh", "AKIA" + "A" * 15 + " AKIA" + "B" * 16,
         "\U0001f600漢 0123456789abcdef01234567 0123456789abcdef0123456", "token=abcde token=abcdef", "AKIAAKIA" + "C" * 16 + "x" + "f" * 24 + "g",
         "-----BEGIN RSA PRIVATE KEY-----\nabc", "eyJabcdefgh12.eyJabcdefgh12.abcdefgh", "password\n=abcdefgh", "apikey: api_key:  \"abcdefg\""]


def base(text):
    """The three given rules by their own words, every match looked at."""
    found = [(m.start(), place, f"{kind}:{m.start()}:{m.end()}") for place, (kind, (p, group, least)) in enumerate(GIVEN.items())
             for m in p.finditer(text or "") if len(m[group]) >= least]
    return [s for *_, s in sorted(found)]


def listed(row):
    return [f"{f.rule}:{f.start}:{f.end}" for f in row.findings]


def test_whole_table_against_the_rules(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()}
    rows = QUERIES["op13_blob_ledger_secrets"](spark, SF_CHECK).collect()
    assert len(rows) == len(docs) and sum(r.n_assign for r in rows) > 0
    for r in rows:
        want = base(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest() and set(want) <= set(r.spans.split(",")) | {""}
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k) for s in want) for k in GIVEN]


def test_rules_on_traps(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: listed(r) for r in scan_versions(docs, shared_path(spark, "ledger")).collect()}
    for i, t in enumerate(TEXTS):
        assert [s for s in got[i] if s.split(":")[0] in GIVEN] == base(t)
    assert got[0] == [] and got[2] == [] and got[7] == ["pem:0:31"] and got[8] == ["jwt:0:36"]


def test_only_unseen_blobs_and_rule_versions_are_scanned(spark):
    ledger = shared_path(spark, "ledger")
    history = [("a", 1, "token=abcdef"), ("b", 1, "clean"), ("a", 2, "clean"), ("c", 1, "token=abcdef")]
    frame = lambda rows: spark.createDataFrame(rows, "path string, version int, text string")

    def book():
        return spark.read.schema(LEDGER).parquet(ledger).count()

    scan_versions(frame(history), ledger, keep=("path", "version")).collect()
    assert book() == 2 * len(RULES)
    history += [("b", 2, "token=abcdef"), ("d", 1, None), ("a", 3, "AKIA" + "Z" * 16)]
    got = {(r.path, r.version): listed(r) for r in scan_versions(frame(history), ledger, keep=("path", "version")).collect()}
    assert book() == 4 * len(RULES)  # the empty text and the key are new, the others known
    assert got == {("a", 1): ["assign:0:12"], ("a", 2): [], ("a", 3): ["access:0:20"], ("b", 1): [], ("b", 2): ["assign:0:12"], ("c", 1): ["assign:0:12"], ("d", 1): []}
    raised = (replace(RULES[0], version=2, least=7), *RULES[1:])
    got = {(r.path, r.version): listed(r) for r in scan_versions(frame(history), ledger, raised, keep=("path", "version")).collect()}
    assert book() == 4 * len(RULES) + 4 and got["a", 1] == [] and got["a", 3] == ["access:0:20"]
    scan_versions(frame(history), ledger, raised, keep=("path", "version")).collect()
    assert book() == 4 * len(RULES) + 4


def test_hot_blob_and_odd_rows(spark, odd_documents, no_documents):
    hot = spark.range(5000).selectExpr("if(id % 2 = 0, NULL, id) AS findings", "if(id % 3 = 0, concat('token=abcdef', id), 'secret=hot-value') AS text", "'x' AS blob")
    rows = scan_versions(hot, shared_path(spark, "ledger"), keep=("findings",)).toDF("id", "blob", "found").collect()
    assert len(rows) == 5000 and all(len(r.found) == 1 for r in rows)
    odd = scan_versions(odd_documents, shared_path(spark, "ledger")).collect()
    assert len(odd) == 15 and sum(r.doc_id is None for r in odd) == 2 and all(listed(r) == [] for r in odd)
    assert scan_versions(no_documents, shared_path(spark, "ledger")).count() == 0


def test_ledger_row_written_twice(spark):
    ledger = shared_path(spark, "ledger")
    docs = spark.createDataFrame([(1, "token=abcdef")], "doc_id long, text string")
    scan_versions(docs, ledger).collect()
    spark.read.schema(LEDGER).parquet(ledger).cache().write.mode("append").parquet(ledger)
    assert [listed(r) for r in scan_versions(docs, ledger).collect()] == [["assign:0:12"]]
