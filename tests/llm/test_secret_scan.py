import base64
import hashlib
import random
import re

from patchlens.llm import secret_scan as scan


def base(text):
    """The contract's three patterns, unprepared."""
    text = text or ""
    assign = r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text, re.ASCII) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def secret(rng, kind):
    raw = rng.randbytes(30)
    return {"hex": raw.hex(), "b64": base64.b64encode(raw).decode(), "b32": base64.b32encode(raw).decode()}[kind]


def test_base_spans():
    texts = [
        None, "", 'password = "abcdefgh"', "PassWD:short", "token : 'x.y=z/12345'", "api_key=aaaaaaaaapikey=bbbbbbbb", "ſecret=abcdefgh",
        "toKen=abcdefgh", "AKIAABCDEFGHIJKL AKIAABC xAKIA0000000000000", "f" * 31 + "G" + "0" * 32, "é secret=12345678 " + "ab" * 20,
        "tokentoken= = token==abcdefghi",
    ]
    for text in texts:
        assert scan.base_spans(text or "") == base(text), text


def test_random_strings_pass_the_battery_and_words_do_not():
    rng = random.Random(1)
    strings = [secret(rng, k) for k in ("hex", "b64", "b32") for _ in range(200)]
    against = [scan.evidence(s.rstrip("=")) for s in strings]
    assert sum(a > 2 for a in against) < 0.05 * len(against)
    ordinary = ["internationalization", "a" * 30, "abcdefghijklmnopqrstuvwxyz", "some_long_identifier_name_here", "path/to/some/file/of/mine"]
    assert all(scan.evidence(s) > 2.5 for s in ordinary)
    assert scan.evidence("1234567890" * 3) is None
    assert scan.evidence("ab+/cd-_" * 4) is None


def test_find_secrets(spark):
    rng = random.Random(2)
    planted = {i: secret(rng, rng.choice(["hex", "b64", "b32"])) for i in range(60)}
    words = ["internationalization", "aaaaaaaaaaaaaaaaaaaaaaaa", "very_long_variable_name_of_mine", "word"]
    rows = [(i, f"é {rng.choice(words)} {s} {rng.choice(words)}") for i, s in planted.items()]
    rows += [(i, " ".join(rng.choice(words) for _ in range(9))) for i in range(100, 160)]
    rows += [(500, None), (501, ""), (501, ""), (None, "password=abcdefgh"), (502, "x " * 200_000)]
    found = scan.find_secrets(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert len(found) == len(rows)
    of = {r.doc_id: r for r in found}
    caught = 0
    for i, t in rows:
        assert [tuple(s) for s in of[i].base] == base(t)
        assert list(of[i].spans) == sorted(of[i].spans) and set(of[i].base) <= set(of[i].spans)
        if i in planted:
            caught += (2, 3)[1] in [s.kind for s in of[i].spans if t[s.start : s.end] == planted[i]]
        elif i is not None and i < 500:
            assert not of[i].spans
    assert caught >= 54


def test_usual_alphabets_and_parts_of_paths_are_found(spark):
    rng = random.Random(4)
    names = ["getElementsByClassNameFromDocument", "AbstractSingletonProxyFactoryBean", "internationalization", "java/lang/reflect/InvocationHandler"]
    rows, planted = [], {}
    for k, (kind, before) in enumerate([("lower36", ""), ("UPPER36", ""), ("base62", ""), ("base62", "hooks/T0_ab/")]):
        for i in range(1000 * k, 1000 * k + 60):
            planted[i] = "".join(rng.choices(scan.ENCODINGS[kind], k=32))
            rows.append((i, f"é {rng.choice(names)} {before}{planted[i]} {rng.choice(names)}"))
    rows += [(i, " ".join(rng.choice(names) for _ in range(9))) for i in range(9000, 9060)]
    found = scan.find_secrets(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    texts, caught = dict(rows), [0, 0, 0, 0]
    for r in found:
        spans = [texts[r.doc_id][s.start : s.end] for s in r.spans]
        assert not any(name in span for span in spans for name in names)
        caught[min(r.doc_id // 1000, 3)] += r.doc_id in planted and planted[r.doc_id] in spans
    assert min(caught) >= 54, caught


def test_a_part_is_left_out_within_a_random_run():
    run = "0aB3-" + "q7Zk2MvX9cLw5RtY1nGh" + "_" + "e" * 24
    whole, *parts = scan.candidates(f"see {run}")
    assert (whole["start"], whole["end"], whole["run_length"]) == (4, 4 + len(run), None)
    assert [p["start"] for p in parts] == [9, 30]
    assert all((p["run_length"], p["run_against"]) == (len(run), whole["against"]) for p in parts)
    assert list(scan.candidates("aB3+/_-" * 6)) == []


def test_step_up_equals_its_definition(spark):
    rng = random.Random(3)
    tests = [(20 + rng.randrange(40), rng.choice([rng.random(), 10 * rng.random()])) for _ in range(400)]
    frame = spark.createDataFrame(
        [(1, [{"start": 0, "end": n, "length": n, "against": a} for n, a in tests])],
        "doc_id bigint, tested array<struct<start: bigint, end: bigint, length: int, against: double>>",
    )
    mean, cut = scan.rejection(frame, 0.05)
    assert mean == sum(n for n, _ in tests) / len(tests)
    p = sorted(10**-a * mean / n for n, a in tests)
    k = max(k for k in range(1, len(p) + 1) if p[k - 1] <= 0.05 * k / len(p))
    rejected = sum(q <= 10**-cut for q in p)
    assert k - 8 <= rejected <= k
    assert scan.rejection(frame.limit(0)) == (1.0, float("inf"))


def test_text_form(spark):
    frame = scan.find_secrets(spark.createDataFrame([(1, "secret=abcdefgh " + "0123456789abcdef" * 2)], "doc_id int, text string"))
    from pyspark.sql import functions as F

    text = frame.select(scan.as_text(F.col("base")), F.sha2(scan.as_text(F.col("base")), 256)).first()
    assert text[0] == "assign:0:15,hex:16:48"
    assert text[1] == hashlib.sha256(text[0].encode()).hexdigest()
