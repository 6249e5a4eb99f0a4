import hashlib
import random
import re

import pytest

from feedworks.llm import secrets

SF001 = "/root/testdata/sf0.001"
ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    text = text or ""
    spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    spans += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    n = [sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")]
    spans.sort(key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))
    return (*n, hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest())


def check(spark, docs):
    want = sorted(((r.doc_id if r.doc_id is not None else -1), *brute(r.text)) for r in docs.collect())
    rows = secrets.scan_secrets(docs).collect()
    assert sorted(((r.doc_id if r.doc_id is not None else -1), r.n_assign, r.n_access, r.n_hex, r.base_sha256)
                  for r in rows) == want
    return rows


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_documents_match_brute_force(spark, sf):
    rows = check(spark, spark.read.parquet(f"/root/testdata/{sf}/documents.parquet"))
    assert any(r.spans for r in rows)


def test_random_fragments(spark):
    rng = random.Random(2)
    bits = ["token", "PassWord", "passwd", "secret", "api_key", "APIKEY", "=", ":", " ", "  ", '"', "'", "abcdef0123456789",
            "AKIA", "AKIAABCDEFGHIJKLMN", "deadbeef", "0123", "x", "\n", "é", "🙂", "", "zz.zz/zz=zz-zz", "ſecret", "K", "."]
    data = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))) for i in range(1500)]
    check(spark, spark.createDataFrame(data, "doc_id long, text string"))


def test_odd_rows(spark):
    key = "AKIA" + "Z9" * 9
    jwt = "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSMeKK"
    data = [(1, None, "r"), (2, "", "r"), (None, "token=" + "a" * 12, "r"), (4, key, "r"), (4, "no secret", "r"), (4, key, "r"),
            (5, "w " * 50000 + "password: 'hunter2hunter2'" + (" " + "ab" * 8) * 900, "r"),
            (6, f"🙂 {jwt} -----BEGIN RSA PRIVATE KEY----- ghp_{'aZ' * 18}", "r")]
    docs = spark.createDataFrame(data, "doc_id long, text string, __row string").withColumnRenamed("__row", "rules")
    rows = check(spark, docs)
    last = next(r for r in rows if r.doc_id == 6)
    kinds = [s.split(":")[0] for s in last.spans.split(",")]
    assert kinds == ["jwt", "pem", "github"] and last.spans.startswith(f"jwt:2:{2 + len(jwt)},")
    out = secrets.redact_secrets(docs)
    assert out.columns == docs.columns
    text = sorted((str(r.doc_id), str(r.text)[:30]) for r in out.collect())
    assert text == sorted([("1", "None"), ("2", ""), ("None", "[SECRET]"), ("4", "[SECRET]"), ("4", "[SECRET]"), ("4", "no secret"),
                           ("5", ("w " * 50)[:30]), ("6", "🙂 [SECRET] [SECRET] [SECRET]")])
    assert all(brute(r.text)[:3] == (0, 0, 0) for r in out.collect())
    empty = spark.createDataFrame([], docs.schema)
    assert secrets.scan_secrets(empty).collect() == [] and secrets.redact_secrets(empty).collect() == []


def test_redaction_updates_length_only_where_text_changed(spark):
    docs = spark.createDataFrame([(1, "token=abcdefghijkl", 99), (2, "plain", 77), (3, None, 5)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in secrets.redact_secrets(docs).collect()}
    assert got == {1: ("[SECRET]", 8), 2: ("plain", 77), 3: (None, 5)}


def test_redaction_gives_back_private_use_characters(spark):
    odd = "\ue000 \ue001\ue000\ue002\ue003 \ue001\ue003 abc\ue000"
    rows = [(1, f"{odd} token=abcdefghijkl {odd}"), (2, odd), (3, f"token=abcdefghijkl\ue000deadbeefdeadbeef\ue001")]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in secrets.redact_secrets(docs).collect()}
    want = {1: f"{odd} [SECRET] {odd}", 2: odd, 3: "[SECRET]\ue000[SECRET]\ue001"}
    assert got == {i: (t, len(t)) for i, t in want.items()}


def test_trigram_queries():
    q = secrets.trigram_query
    assert q("[0-9a-f]{16,}") is True and q("ab") is True and q("x*") is True
    assert q("abcd") == ("and", "abc", "bcd")
    assert q("(?:abc|abd)[0-9]+") == ("or", "abc", "abd")
    assert q("(AKIA[A-Z0-9]+)") == ("and", "aki", "kia")
    assert q("abc.*def") == ("and", "abc", "def")
    assert q("(?:abc)?x") is True and q("(?:abc)+") == "abc"
    found = q(secrets.BASE[0].pattern)
    assert found[0] == "or" and len(found) == 7 and ("and", "ken", "oke", "tok") in found


def test_plan_runs_no_python(spark, capsys):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    secrets.scan_secrets(docs).explain()
    assert "Python" not in capsys.readouterr().out


def test_private_keys_go_with_their_body(spark):
    rng = random.Random(5)
    line = lambda n: "".join(rng.choice("ABCDEFGHabcdefgh0123456789+/") for _ in range(n))
    head, foot = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    body = [line(64) for _ in range(25)] + [line(10) + "=="]
    coded = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123456789ABCDEF\n\n"
    blocks = ["\n".join([head, *body, foot]), "\r\n".join([head, *body, foot]), " ".join([head, *body, foot]), "\\n".join([head, *body, foot]),
              head + "\n" + coded + "\n".join([*body, foot]), "\n".join([head, *body]), head + "\n" + "\n".join(body[:-1]),
              head + "\n" + coded + "\n".join(body), "\n".join([head, *[line(64) for _ in range(20000)], foot]),
              "\n".join([head, *[line(64) for _ in range(20000)]]), head]
    texts = [(f"before 🙂 {x}", "\nwith words after it.") for x in blocks]
    docs = spark.createDataFrame([(i, a + b) for i, (a, b) in enumerate(texts)], "doc_id long, text string")
    spans = {r.doc_id: [s for s in r.spans.split(",") if s.startswith("pem")] for r in secrets.scan_secrets(docs).collect()}
    assert spans == {i: [f"pem:9:{len(a)}"] for i, (a, _) in enumerate(texts)}
    got = {r.doc_id: r.text for r in secrets.redact_secrets(docs).collect()}
    assert got == {i: f"before 🙂 [SECRET]{b}" for i, (_, b) in enumerate(texts)}
    two = spark.createDataFrame([(1, f"{blocks[0]}\nThanks\n{blocks[5]}\nThat was all of it."), (2, f"{head}\nThanks for it\nNote: none")],
                                "doc_id long, text string")
    assert {r.doc_id: r.text for r in secrets.redact_secrets(two).collect()} == {
        1: "[SECRET]\nThanks\n[SECRET]\nThat was all of it.", 2: "[SECRET]\nThanks for it\nNote: none"}


def test_private_key_is_asked_for_by_its_header_alone():
    found = secrets.trigrams_of(secrets.trigram_query(secrets.MORE[2].pattern))
    assert found and found == secrets.trigrams_of(secrets.trigram_query("(-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----)"))
