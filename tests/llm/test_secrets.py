"""op11 against the patterns as they are written, and against planted assignments."""

import hashlib
import random
import re

import pytest

from layerflow.llm import secret_scan as sec

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def _plain(text):
    """Base spans from the patterns, a text without letters that fold into ASCII."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(("assign", "access", "hex")[k], s, e) for s, k, e in sorted(found)]


def _check(got, rows):
    def digest(text):
        base = _plain(text)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        return [sum(k == kind for k, _, _ in base) for kind in ("assign", "access", "hex")] + [hashlib.sha256(joined.encode()).hexdigest()]

    mine = [[r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256] for r in got]
    assert sorted(map(repr, mine)) == sorted(map(repr, ([i, *digest(t)] for i, t in rows)))
    for r in got:
        spans = [s.split(":") for s in r.spans.split(",") if s]
        order = [(int(s), sec.KINDS.index(k), int(e)) for k, s, e in spans]
        assert order == sorted(order)
        base = ",".join(":".join(s) for s in spans if s[0] != "literal")
        assert hashlib.sha256(base.encode()).hexdigest() == r.base_sha256 and sum(s[0] == "literal" for s in spans) == r.n_literal


def test_documents(documents, odd, odd_rows, none):
    _check(sec.secret_digest(documents).collect(), [(r.doc_id, r.text) for r in documents.collect()])
    _check(sec.secret_digest(odd).collect(), [(r[0], r[1]) for r in odd_rows])
    assert sec.secret_digest(none).count() == 0


def test_random_base_spans():
    rnd = random.Random(3)
    parts = ["password", "PassWd", "Secret", "tokEN", "api_key", "apikey", '"', "'", " ", ":", "=", "abc", "=token:abcdefgh", "AKIA", "AKIA" + "Z9" * 9,
             "0123456789abcdef", "deadbeefdeadbeef", "\n", "x", "😀", "é", "A-._+/"]
    for _ in range(20_000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 14)))
        assert sec.base_spans(text) == _plain(text), text
    assert sec.base_spans("paſſword=abcdefgh toKen=abcdefgh") == []  # letters that only Unicode folds


@pytest.mark.parametrize("text,secret", [
    ('password = "hunter2xyz9"', "hunter2xyz9"), ('a = "Zx9!kk22pq"\nb = a\ndb_password = b', "Zx9!kk22pq"),
    ("config['client_secret'] = 'q8Wd-77a'", "q8Wd-77a"), ("const dbPassword: string = `p@ss-W0rd1`;", "p@ss-W0rd1"),
    ("OTHER=Ab12cd34ef\nexport TOKEN=${OTHER}", "Ab12cd34ef"), ("<password>tr0ub4dor&3</password>", "tr0ub4dor&3"),
    ('x = "Aa9-zzQQ" # note\npassword=x\n', "Aa9-zzQQ"), ("secretKey => 'k3y-0f-Doom'", "k3y-0f-Doom"), ('pwd: str = "Qwerty!23"', "Qwerty!23"),
    ('base = "Tr1cky-Value"\nurl = "x:${base}"\nauth_token = url', "Tr1cky-Value"), ('conn(user="bob", password="s3cr3t-Pa55")', "s3cr3t-Pa55"),
    ('{"privateKey": "MIIEvQIBADANBg9"}', "MIIEvQIBADANBg9"), ('k = "A1"\nk += "C3d4e5F6"\nsecret = k', "C3d4e5F6"),
])
def test_literals_reach_names(text, secret):
    assert [text[s:e] for s, e, _, _ in sec.literal_spans(text)] == [secret]


@pytest.mark.parametrize("text", [
    "the secret: something nice", "password: changeme", 'password_file = "/etc/x"', "don't say password: it's fine", "token_count = 12345678",
    'password := getenv("DB_PASSWORD")', 'auth = "Bearer " + tok', "export TOKEN=${OTHER}\nOTHER=Ab12cd34ef", 'x = "Aa9-zzQQ"\nx = 1\npassword = x',
    "", "=", "password =", "password = \n", 'password = "', "a = a\npassword = a", "key = value", 'name = "Zx9!kk22pq"', 'csrf_token = "Zx9!kk22pq"',
])
def test_harmless(text):
    assert sec.literal_spans(text) == []


def test_names():
    s = sec.sensitivity
    assert s("db.password") == s("DB_PASSWORD") == s("dbPassword") == 1.0 and s("api_key") == s("accessKey") == 0.9
    assert s("key") == s("monkey") == s("compass") == s("tokenizer") == 0.0 and s("password_hint") < 0.5 and s("secret_id") < 0.5


def test_long_chains_are_linear():
    chain = 'v0 = "Zx9!kk22pq"\n' + "".join(f"v{i} = v{i - 1} + v{i - 1}\n" for i in range(1, 30_000)) + "password = v29999\n"
    assert [n for _, _, n, _ in sec.literal_spans(chain)] == ["password"]
    grown = 'token = "Aa1-Bb2-Cc3"\n' + 'token += "Dd4-Ee5-Ff6"\n' * 20_000
    assert len(sec.literal_spans(grown)) == 20_001
    assert sec.literal_spans("password = " + '"' * 100_001 + "<a>" * 50_000) == []
