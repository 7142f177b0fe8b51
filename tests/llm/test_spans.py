"""Personal data and secrets, against the same patterns in Python."""

import hashlib
import random
import re

from tests.llm import data
from tremorline.llm import pii, secrets

PERSONAL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(v - 9 * (v > 9) for v in doubled) % 10 == 0
    return kind != "phone" or 8 <= len(digits) <= 15


def personal(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PERSONAL.items() for m in re.finditer(p, text) if valid(k, m[0])]


def secret(text):
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(found)]


def sha(spans):
    return hashlib.sha256(",".join(spans).encode()).hexdigest()


def made(parts, n, longest, seed=5):
    rnd = random.Random(seed)
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, longest))) for _ in range(n)]
    return [*enumerate(texts), *((10_000 + i, t) for i, (_, t) in enumerate(data.TEXTS))]


def test_personal_data(spark):
    rows = made(["a", "b.c", "@", "@x", "x.y", ".", "-", "+1", "+", "4539578763621486", "4111 1111 1111 1111", " ", "  ", "(555)",
                 "255", "256", "0", "12", "1.2.3.4", "é", "𝄞", "\n", "a@b.c", "%", "_", "+49 30 1234567"], 1500, 25)
    rows += [(1, "1" * 2000), (2, "a" * 2000 + "@" + "b." * 2000 + "c"), (3, "1-" * 2000 + "1 a@b.co"), (4, "1.1." * 2000)]
    got = {r["doc_id"]: r for r in pii.report(pii.find_personal_data(data.plain(spark, rows[:-4]))).collect()}
    assert len(got) == len(rows) - 4
    assert all(got[i]["base_sha256"] == sha(personal(t or "")) for i, t in rows[:-4])
    odd = {r["doc_id"]: r for r in pii.report(pii.find_personal_data(data.plain(spark, rows[-4:]))).collect()}
    assert all(odd[i]["base_sha256"] == sha(personal(t)) for i, t in rows[-4:])
    assert all(sum(odd[i][f"n_{k}"] for k in PERSONAL) == len(personal(t)) for i, t in rows[-4:])


def test_very_long_runs_need_no_stack(spark):
    rows = [(1, "1-" * 100_000), (2, "a@" + "b." * 100_000), (3, "token " * 50_000), (4, "9" * 300_000)]
    assert pii.find_personal_data(data.plain(spark, rows)).count() == 4
    assert secrets.scan(data.plain(spark, rows)).count() == 4


def test_terms_that_disclose(spark):
    """One word stands only next to one address; a common word stands there too, but tells nothing."""
    rows = [(i, f"the project kestrel{'x' * (i % 2)} is run by ann.lee@corp.org and the team since {i}") for i in range(8)]
    rows += [(100 + i, f"the team of the day number {i} is run by someone else since then") for i in range(60)]
    found = pii.find_personal_data(data.plain(spark, rows))
    got = {r["doc_id"]: r for r in pii.report(found).collect()}
    text = dict(rows)[0]
    terms = {text[int(s.split(":")[1]) : int(s.split(":")[2])] for s in got[0]["spans"].split(",") if s.startswith("term")}
    assert "kestrel" in terms and "project" in terms and not terms & {"the", "team", "run", "since"}
    assert got[0]["n_email"] == 1 and got[100]["spans"] == ""
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(data.plain(spark, rows)).collect()}
    assert "kestrel" not in clean[0] and "ann.lee" not in clean[0] and "[email]" in clean[0]
    assert clean[100] == dict(rows)[100]


def test_terms_that_disclose_an_entity_of_one_document(spark, monkeypatch):
    rows = [(0, "the project kestrel is run by ann.lee@corp.org and the team since then")]
    rows += [(100 + i, "the team of the project is run by someone else and since then") for i in range(60)]
    for bound in (pii.TERMS_TO_SEND, 0):
        monkeypatch.setattr(pii, "TERMS_TO_SEND", bound)
        clean = {r["doc_id"]: r["text"] for r in pii.sanitise(data.plain(spark, rows)).collect()}
        assert clean[0] == "the project  is run by [email] and the team since then" and clean[100] == rows[1][1]


def test_odd_tables(spark):
    assert len(pii.report(pii.find_personal_data(data.odd(spark))).collect()) == len(data.TEXTS)
    assert len(secrets.report(secrets.scan(data.odd(spark))).collect()) == len(data.TEXTS)
    assert pii.find_personal_data(data.empty(spark)).count() == 0 and secrets.scan(data.empty(spark)).count() == 0


def test_secrets(spark):
    rows = made(["token", "Secret", "API_KEY", "apikey", "passwd", "=", " : ", "'", '"', ":", " ", "AKIA", "AKIAQWERTYUIOP12345",
                 "abcdef0123456789ff", "deadbeef", "0123456789", "é", "𝄞", "abcdefghijkl", "xyz", "-", "."], 1500, 20)
    got = {r["doc_id"]: r for r in secrets.report(secrets.scan(data.plain(spark, rows))).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["base_sha256"] == sha(secret(t or "")) for i, t in rows)


def test_random_strings_by_their_steps(spark):
    rnd = random.Random(8)
    letters = secrets.ALPHABET[:62]

    def drawn(n):
        return "".join(rnd.choice(letters) for _ in range(n))

    names = ["customer", "account", "balance", "transfer", "number", "received", "address", "country", "payment", "holder"]

    def word():
        return "".join(rnd.choice(names) for _ in range(3))

    rows = [(i, f"password = {drawn(40)} for {word()} and {word()}") for i in range(400)]
    held = [(1000 + i, f"see {drawn(32)} here") for i in range(100)]
    plain = [(2000 + i, f"see {word()} here") for i in range(100)]
    table = secrets.learn(data.plain(spark, rows))
    got = {r["doc_id"]: len(r["markov"]) for r in secrets.scan(data.plain(spark, held + plain), table).collect()}
    assert sum(got[i] for i, _ in held) >= 95 and sum(got[i] for i, _ in plain) == 0
