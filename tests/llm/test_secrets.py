from __future__ import annotations

import hashlib
import re

import pytest

from rideflow.llm import secrets

A = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    """The base findings straight from their patterns."""
    text = text or ""
    found = [("assign", m) for m in A.finditer(text) if len(m[2]) >= 6]
    found += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    order = ["assign", "access", "hex"]
    spans = sorted((m.start(), order.index(k), k, m.end()) for k, m in found)
    joined = ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans)
    counts = [sum(k == kind for *_, k, _ in spans) for kind in order]
    return (*counts, hashlib.sha256(joined.encode()).hexdigest(), joined)


KEY = "AKIA" + "Q7" * 9
HEX = "0f" * 14
TEXTS = [
    None, "", " ", "nothing here, really", "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\"###", "TOKEN:abcde", "Token : 'abcdef'",
    f"é\U0001F600 api_key=x{KEY} {KEY}", f"AKIA123 AKIA{'A' * 15} {KEY}{KEY}", HEX, HEX[:23], f"{HEX}g{HEX}", "apikey == abcdef1", "tokentoken=token=aaaaaa",
    "paſſword=abcdef1 password=K234567", "secret = secret: secret=abcdefg", "passwd:\n abcdefgh", "token" + " " * 5000 + "=abcdef",
    "passwordpassword" * 300 + "=hunter22", "x = 'Zk93hdbA72hsQx01'\nclientSecret = x", "a" * 20000, "=" * 3000 + ":" * 3000,
]


@pytest.fixture(scope="module")
def scanned(spark):
    return {r.doc_id: r for r in secrets.secret_report(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")).collect()}


@pytest.mark.parametrize("i", range(len(TEXTS)))
def test_base_findings(scanned, i):
    r, (n_assign, n_access, n_hex, digest, joined) = scanned[i], brute(TEXTS[i])
    assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == (n_assign, n_access, n_hex, digest)
    assert set(joined.split(",")) - {""} <= set(r.spans.split(","))


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = secrets.secret_report(docs).collect()
    assert len(rows) == len(texts)
    assert all((r.n_assign, r.n_access, r.n_hex, r.base_sha256) == brute(texts[r.doc_id])[:4] for r in rows)


STRONG = "Zk93hdbA72hsQx01"


@pytest.mark.parametrize("text, found", [
    (f"x = '{STRONG}'\nclientSecret = x", [STRONG]),
    (f"x = '{STRONG}'\ny = x\nDB_PASSWORD = y", [STRONG]),
    (f'prefix = "{STRONG}"\nauth_credential = prefix + "9f8Gd72KQwe1"', [STRONG, "9f8Gd72KQwe1"]),
    (f'{{"private_key": "{STRONG}"}}', [STRONG]),
    (f'config["pwd"] = "{STRONG}"', [STRONG]),
    (f"signing_key: str = `{STRONG}`", [STRONG]),
    (f"export AWS_ACCESS_KEY={STRONG}", [STRONG]),
    (f"credentials:\n  pwd: {STRONG}", [STRONG]),
    (f"label = '{STRONG}'", []),
    (f"x = '{STRONG}'\nx = 'plain'\npwd = x", []),
    ("pwd = 'changeme'", []), ("credential: required for entry", []), ("public_key = 'Zk93hdbA72hsQx01'", []), ("pwd = ''", []),
    ("if a == pwd: return", []), ("note: the word and = sign", []), ("pwd = pwd", []), ('pwd = "unclosed ' + STRONG, []),
])
def test_names_and_constants(text, found):
    assert [text[s.start : s.end] for s in secrets.secret_spans(text) if s.kind == "named"] == found


def test_masked_texts_hold_no_secret(spark):
    rows = [(i, t, "src", len(t or ""), "kept") for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, secrets string")
    out = secrets.without_secrets(df)
    assert out.columns == df.columns
    for r in out.collect():
        before = TEXTS[r.doc_id]
        if before is None:
            assert r.text is None and r.n_chars == 0
            continue
        assert secrets.secret_spans(r.text) == [] and r.n_chars == len(r.text) and r.secrets == "kept"
        if not secrets.secret_spans(before):
            assert r.text == before


def test_no_rows_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "token=abcdef", 3)], "doc_id long, text string, Secrets int")
    row = secrets.secret_scan(df).first()
    assert row["Secrets"] == 3 and row["secrets_"][0]["kind"] == "assign"
    assert secrets.secret_report(df.limit(0)).count() == 0


def test_long_texts_take_linear_time():
    import time

    for text in ("a" * 2_000_000, "password " * 200_000, 'x="' * 300_000, "k=v " * 300_000, "token" + " " * 1_000_000):
        started = time.process_time()
        secrets.secret_spans(text)
        assert time.process_time() - started < 10


@pytest.mark.parametrize("text, found", [
    (f'pwd = f"{STRONG}"', [STRONG]), (f'SECRET_PWD="""{STRONG}"""', [STRONG]), (f'pwd = (\n  "{STRONG}"\n)', [STRONG]),
    (f'pwd, user = "{STRONG}", "me"', [STRONG]), (f"run --pwd {STRONG} -x", [STRONG]), (f"run --pwd={STRONG}", [STRONG]),
    (f'k = "{STRONG}"\ncfg.set("pwd", k)', [STRONG]), (f'os.environ.get("DB_PWD", "{STRONG}")', [STRONG]),
    (f"pwd: |\n  {STRONG}\n  9f8Gd72KQwe1\nuser: x", [STRONG, "9f8Gd72KQwe1"]), (f"<pwd>{STRONG}</pwd>", [STRONG]), (f"<pwd><![CDATA[{STRONG}]]></pwd>", [STRONG]),
    (f'<add key="pwd" value="{STRONG}"/>', [STRONG]), (f'pwd = k\nk = "{STRONG}"', [STRONG]), (f'pwd = os.getenv("X") or "{STRONG}"', [STRONG]),
    (f'pwds = 1\npwd = ["{STRONG}", "{STRONG}2"]', [STRONG, STRONG + "2"]), (f"pwd = (\"Zk93hdbA\"\n   '72hsQx01')", ["Zk93hdbA", "72hsQx01"]),
    (f'$pwd = "x" . "{STRONG}";', ["x", STRONG]), ('pwd = os.getenv("X")', []), (f'connect(host, user="{STRONG}")', []), (f'connect(host, pwd="{STRONG}")', [STRONG]),
    ("pwd = user.password", []), ("a=b\nb=a\npwd=a", []), (f"pwd, user = '{STRONG}'", []),
])
def test_forms_of_assignment(text, found):
    assert [text[s.start : s.end] for s in secrets.secret_spans(text) if s.kind == "named"] == found


@pytest.mark.parametrize("seed", range(30))
def test_constants_reach_sensitive_names(seed):
    """Random programs against an interpreter: the literals that a password is made of, in whatever order names are bound."""
    import random

    rng = random.Random(seed)
    names = [f"v{i}" for i in range(12)] + ["pwd", "db_pwd", "api_key", "label"]
    rng.shuffle(names)
    values, lines = {}, []
    for i, name in enumerate(names):  # later names may be used before they are bound, but never in a circle
        parts = [rng.choice(names[i + 1 :]) if names[i + 1 :] and rng.random() < 0.6 else f"L{i}x{k}Zq{rng.randrange(10**6)}" for k in range(rng.randint(1, 3))]
        values[name] = parts
        lines.append(f"{name} = " + " + ".join(p if p in names else f"'{p}'" for p in parts))
    rng.shuffle(lines)
    whole = lambda name: [x for p in values[name] for x in (whole(p) if p in values else [p])]
    wanted = {x for name in ("pwd", "db_pwd", "api_key") if secrets.name_score(name) * secrets.literal_score("".join(whole(name))[:256], True) >= secrets.NAMED_FROM for x in whole(name)}
    text = "\n".join(lines)
    assert {text[s.start : s.end] for s in secrets.named_spans(text)} == wanted and wanted


@pytest.mark.parametrize("text", [
    "a = 'Zk93hdbA72hsQx01'\n" + "a = a + a\n" * 10_000 + "pwd = a\n",
    "a0 = 'Zk93hdbA'\na1 = 'x72hsQx01'\n" + "".join(f"a{i} = a{i - 1} + a{i - 2}\n" for i in range(2, 10_000)) + "pwd = a9999\n",
    "".join(f"a{i} = a{i + 1} + a{i + 2}\n" for i in range(10_000)) + "a10000 = 'Zk93hdbA72hsQx01'\npwd = a0\n",
])
def test_constants_of_long_chains(text):
    import time

    started = time.process_time()
    assert secrets.named_spans(text)
    assert time.process_time() - started < 2


@pytest.mark.parametrize("unit", ["key=", "pwd, key, ", "key=(a,", "key=[a,", "key=a+", "key=f(", "(key", "--key ", 'key="""', "key\n\\\n", "key: |\n", "<key a="])
def test_odd_syntax_takes_linear_time(unit):
    import time

    started = time.process_time()
    secrets.secret_spans(unit * 100_000)
    assert time.process_time() - started < 8
