import re

from parley.llm import secrets

TOKEN = "AbCd1234EfGh5678IjKl9012"


def brute(text):
    """Base spans, and wider candidates that no base span overlaps, by plain loops."""
    found = [(m.start(), 0, m.end()) for m in re.finditer(secrets.ASSIGN, text) if len(m.group(2)) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 32]
    covered = bytearray(len(text))
    for start, _, end in found:
        covered[start:end] = b"\1" * (end - start)
    wider = []
    for m in re.finditer(r"[A-Za-z0-9_+/-]+", text):
        mixed = re.search("[0-9]", m.group()) and re.search("[A-Za-z]", m.group()) and not re.fullmatch("[0-9a-f]+", m.group())
        if len(m.group()) >= 24 and mixed and not any(covered[m.start() : m.end()]):
            wider.append((m.start(), 3, m.end()))
    return ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(found + wider))


def test_spans_of_texts_with_many_matches_equal_plain_loops(spark):
    forms = ["password = hunter2hunter{0}", "AKIA{0:016d}", "{0:032x}", TOKEN + "{0}", "token: {0:032x}", "\u00fcber\U0001f600 api_key='k{0:09d}'", "password=short", "x{0:040x}"]
    texts = [" ".join(forms[(i * i + i // 7) % len(forms)].format(i) for i in range(n)) for n in (0, 1, 2, 3, 9, 10, 500)]
    many = " ".join(f"secret={i:08d} {TOKEN}{i}" for i in range(20_000))
    texts += [many, "plain words only", None]
    rows = [(i, t, "o", f"r{i}", "x", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, repo string, hash string, start int")
    got = {r["doc_id"]: r["spans"] for r in secrets.scan(docs).collect()}
    assert got == {i: brute(t or "") for i, t in enumerate(texts)}
    assert got[len(texts) - 3].count(",") == 39_999


def test_owners_decide_over_the_whole_corpus(spark):
    held = [("a", 50), ("b", 2), ("c", 3)]
    rows = [(k * 100 + i, f"see {TOKEN}{k} here", f"owner{i % n if n < 50 else 0}") for k, (_, n) in enumerate(held) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: (r["spans"], r["n_live"], r["n_repositories"]) for r in secrets.scan(docs).collect()}
    owners = {k: len({o for d, _, o in rows if d // 100 == k}) for k in range(3)}
    assert owners == {0: 1, 1: 2, 2: 3}
    for doc, (_, n) in ((d, held[d // 100]) for d, _, _ in rows):
        assert got[doc] == (("owned:4:29", 1, n) if owners[doc // 100] <= 2 else ("", 0, 0))
    assert secrets.scan(docs.limit(0)).count() == 0
