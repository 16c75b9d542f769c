"""The pseudonyms against a Feistel network in plain Python, and very long texts."""

import datetime
import hashlib
import random

from tickflow.llm import jaccard_join, pii, quality_rules, toxicity

KEY = "a key"


def noise(kind, turn, half, tweak=None):
    parts = [KEY, kind, str(turn) + "\x1f" + half] if tweak is None else [KEY, kind, str(turn) + "\x1f" + half, tweak]
    return hashlib.sha256("\x1f".join(parts).encode()).hexdigest()


def network(text, kind, tweak=None):
    a, b = text[:len(text) // 2], text[len(text) // 2:]
    for turn in range(1, 9):
        digest, moved = noise(kind, turn, b, tweak), ""
        for i, c in enumerate(a):
            block = digest if i < 16 else hashlib.sha256((digest + str(i // 16)).encode()).hexdigest()
            shift = int(block[i % 16 * 4:i % 16 * 4 + 4], 16)
            alphabet = next((x for x in pii.CLASSES if c in x), None)
            moved += alphabet[(alphabet.index(c) + shift) % len(alphabet)] if alphabet else c
        a, b = b, moved
    return a + b


def pair(high, low, of_high, of_low, kind):
    for turn in range(1, 9):
        if turn % 2:
            high = (high + int(noise(kind, turn, str(low))[:12], 16)) % of_high
        else:
            low = (low + int(noise(kind, turn, str(high))[:12], 16)) % of_low
    return high, low


def card(digits):
    body = network(digits[:-1], "card")
    total = sum(sum(map(int, str(int(c) * (2 - i % 2)))) for i, c in enumerate(reversed(body)))
    return body + str(-total % 10)


def ssn(value):
    area, rest = pair(int(value[:3]) - 1, int(value[4:6] + value[7:]), 899, 1_000_000, "ssn")
    rest = f"{rest:06d}"
    return f"{area + 1:03d}-{rest[:2]}-{rest[2:]}"


def ip(value):
    a, b, c, d = map(int, value.split("."))
    high, low = pair(a * 256 + b, c * 256 + d, 65536, 65536, "ip")
    return f"{high >> 8}.{high & 255}.{low >> 8}.{low & 255}"


def date(value):
    first = datetime.date(1800, 1, 1)
    high, low = pair(*divmod((datetime.date.fromisoformat(value) - first).days, 773), 189, 773, "date")
    return str(first + datetime.timedelta(days=high * 773 + low))


def phone(value):
    digits = value.replace("-", "")
    away = str.maketrans("2345678901", pii.EIGHT + pii.TWO)
    back = str.maketrans(pii.EIGHT + pii.TWO, "2345678901")
    out = network(digits[0].translate(away) + digits[1:3] + digits[3].translate(away) + digits[4:], "phone").translate(back)
    return f"{out[:3]}-{out[3:6]}-{out[6:]}"


def test_pseudonyms_equal_a_plain_network(spark):
    draw = random.Random(3)
    cases = {"4111111111111111": card("4111111111111111"), "4111111111111112": network("4111111111111112", "account")}
    for _ in range(25):
        v = f"{draw.randint(1, 899):03d}-{draw.randint(0, 99):02d}-{draw.randint(0, 9999):04d}"
        cases[v] = ssn(v)
        v = ".".join(str(draw.randint(0, 255)) for _ in range(4))
        cases[v] = ip(v)
        v = str(datetime.date(1800, 1, 1) + datetime.timedelta(days=draw.randint(0, 146_096)))
        cases[v] = date(v)
        v = f"{draw.randint(200, 999)}-{draw.randint(200, 999)}-{draw.randint(0, 9999):04d}"
        cases[v] = phone(v)
        local = "".join(draw.choice("abcXYZ019") for _ in range(draw.randint(1, 90)))
        cases[f"{local}@Mail.example.org"] = network(local, "email", "mail.example.org") + "@Mail.example.org"
        cases[f"token={local:a<12}"] = "token=" + network(f"{local:a<12}", "secret")
        v = "".join(draw.choice(pii.UPPER + pii.DIGITS) for _ in range(16))
        cases[f"AKIA{v}"] = "AKIA" + network(v, "key")
    docs = spark.createDataFrame([(f"see {v} now", f"see {p} now") for v, p in cases.items()], "text string, want string")
    got = pii.masked(docs, "text", KEY).select("text", "masked", "want").collect()
    assert len(got) == len(cases) and [r for r in got if r.masked != r.want] == []


def test_the_key_comes_from_the_session(spark):
    assert pii.key_of(spark) == pii.EXAMPLE_KEY
    spark.conf.set(pii.KEY_SETTING, "other")
    try:
        assert pii.key_of(spark) == "other"
    finally:
        spark.conf.unset(pii.KEY_SETTING)


def test_very_long_texts(spark):
    """A megabyte in one word, in one line, and in many lines, each with a value at its end."""
    end = "mail jo@example.org or 123-45-6789"
    texts = ["x" * 1_000_000, "word " * 200_000 + end, ("some words of a plain line here.\n" * 30_000) + end,
             "word " * 200_000 + end, None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    masked = {r.doc_id: r for r in pii.pseudonymise(docs, KEY).collect()}
    assert masked[0].text == texts[0] and masked[1].text == masked[3].text
    for i in (1, 2):
        assert masked[i].n_found == 2 and masked[i].text.endswith(ssn("123-45-6789"))
        assert masked[i].text[:-len(end)] == texts[i][:-len(end)]

    links = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs, 4, 85).collect()}
    assert links[0] == (1, 0) and links[1][1] == links[3][1] == 1 and links[4] == (0, 4) and links[5] == (0, 5)

    lines = {r.doc_id: r for r in quality_rules.line_first(docs).collect()}
    assert [lines[i].n_words for i in range(6)] == [1, 200_004, 210_004, 200_004, 0, 0]
    assert lines[0].word_chars == 1_000_000 and lines[0].base_failed and lines[2].n_dup_lines == 29_999

    # two long words that are equal in their first 100 characters are different features
    long_words = ["a" * 150 + "b", "a" * 150 + "c"]
    assert toxicity.word_features(long_words[0])[0] != toxicity.word_features(long_words[1])[0]
    model = [(0, "bias", 0, -5.0), (0, "word", toxicity.word_features(long_words[0])[0], 9.0)]
    rows = spark.createDataFrame([(0, long_words[0]), (0, long_words[0]), (1, long_words[1]), (2, texts[1])],
                                 "doc_id long, text string")
    got = sorted((r.doc_id, r.rejected) for r in toxicity.score_chain(rows, model).collect())
    assert got == [(0, True), (0, True), (1, False), (2, False)]
    assert sorted(r.doc_id for r in toxicity.without_toxic(rows, model).collect()) == [1, 2]
