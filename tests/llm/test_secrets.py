import base64
import hashlib
import random
import re

from llm_data import docs

from stockgap.llm import secrets

RULES = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
         ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20), ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24)]


def _plain(text):
    found = [(m.start(), i, m.end(), k) for i, (k, rx, ok) in enumerate(RULES) for m in rx.finditer(text or "") if ok(m)]
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(found)]


def _cases():
    rng = random.Random(1)
    pieces = ["password", "PassWd", "secret", "token", "api_key", "apikey", "=", ":", " ", '"', "'", "AKIA", "0a1b2c3d4e5f", "ABCDEF12345", "é", "ſecret", "abcdef", "\n", "."]
    return [None, "", *["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 40))) for _ in range(300)], "x" * 100_000 + " token=abcdef1"]


def test_base_spans_against_the_rules(spark):
    texts = _cases()
    got = {r.doc_id: r for r in secrets.digests(secrets.find_secrets(docs(spark, list(enumerate(texts))))).collect()}
    for i, t in enumerate(texts):
        want = _plain(t)
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [s for s in got[i].spans.split(",") if s and not s.startswith("novel")] == want
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(s.startswith(k) for s in want) for k in ("assign", "access", "hex"))


def test_novelty_reports_what_nothing_around_explains(spark):
    rng = random.Random(2)
    key = base64.b64encode(rng.randbytes(30)).decode()
    code = "def connect(database_connection, retry_policy):\n    return open_session(database_connection, retry_policy)\n" * 3
    rows = [(1, code + f"Authorization: Bearer {key}\n" + code), (2, code + "auth_provider bearer open_Session_database_Connection_retry_Policy2\n" + code),
            (3, code + f"checksum {key}\n" + code), (4, "signature open_session(database_connection, retry_policy)")]
    rows += [(10 + i, code + "credentials database_Connection_retry_Policy2\n" + code) for i in range(20)]
    got = {r.doc_id: r for r in secrets.find_secrets(docs(spark, rows)).collect()}
    assert [n.text for n in got[1].novel] == [key]
    assert rows[0][1][got[1].novel[0].start: got[1].novel[0].end] == key
    assert all(not r.novel for i, r in got.items() if i != 1)


def test_ids_null_and_repeated_and_no_rows(spark):
    got = secrets.digests(secrets.find_secrets(docs(spark, [(None, "token: abcdefg"), (1, "token: abcdefg"), (1, "token: abcdefg")]))).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "1", "None"] and {r.spans for r in got} == {"assign:0:14"}
    assert secrets.find_secrets(docs(spark, [])).count() == 0


def test_names_from_anywhere_in_the_corpus_explain(spark):
    code = "def run(task):\n    return task.result()\n" * 3
    name = "GoogleCredentialsProviderFactory"
    rows = [(i, f"{'words and lines ' * 40}\nimport {name}\n") for i in range(5)] + [(9, code + f"# auth {name}\n" + code)]
    got = {r.doc_id: r.novel for r in secrets.find_secrets(docs(spark, rows)).collect()}
    assert not any(got.values())


def test_a_key_before_the_word_and_one_in_many_documents(spark):
    key = base64.b64encode(random.Random(3).randbytes(30)).decode().replace("+", "a").replace("/", "b").rstrip("=")
    code = "def run(task):\n    return task.result()\n" * 3
    rows = [(1, code + f"{key} # api key\n" + code)] + [(2 + i, code + f"bearer {key}\n" + code) for i in range(4)]
    got = {r.doc_id: r for r in secrets.find_secrets(docs(spark, rows)).collect()}
    assert all([n.text for n in r.novel] == [key] for r in got.values())


def test_candidates_on_both_sides():
    key = "aB3" * 2000
    found = lambda text: [c[3] for c in secrets.candidates(text, [])]
    assert found(f"{key} # token") == [key] and found(f"token # {key}") == [key]
    assert found(f"{key} {'x ' * 30} token") == [] and found("x" * 9000 + " " + "aB3" * 6 + " secret") == ["aB3" * 6]
