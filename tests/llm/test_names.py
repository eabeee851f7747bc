"""Names that come again without a form of address, and the newer kinds of personal data."""

import random
import re

from eventflow.llm.pii import ADDRESS, replace_personal_data

NAMES = "Smith Lopez Müller McDonald O'Neill Okafor Иванов Петрова Παπάς Anna John Kim".split()
WORDS = "the came house Smithson Annaberg said that and was ill müller kimono".split()
WORD = re.compile(r"[^\W\d_](?:[^\W\d_]|['’](?!s\b))*")
FORM = {w: g for g, words in ADDRESS.items() for w in words.split()}


def rows(spark, texts, key="key"):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    return {r.doc_id: r for r in replace_personal_data(df, key).collect()}


def told(words):
    """Names of a text by the plain rule: up to three capitalised words after a form of address."""
    names = []
    for i, w in enumerate(words):
        j = i + 1
        while w in FORM and j < len(words) and j <= i + 3 and words[j][:1].isupper() and words[j] not in FORM:
            names.append(words[j])
            j += 1
    return names


def test_every_mention_of_a_name_is_replaced_alike(spark):
    rng, texts = random.Random(5), []
    for _ in range(150):
        parts = []
        for _ in range(rng.randrange(1, 12)):
            name = rng.choice(NAMES)
            parts += rng.choice([[rng.choice(WORDS)], [name], [rng.choice(["Mr", "Frau", "Dr"]), name, "came"], [name.upper(), "and"]])
        texts.append(" ".join(parts))
    done, fakes = rows(spark, texts), {}
    for i, text in enumerate(texts):
        before, after = text.split(" "), done[i].text.split(" ")
        assert len(before) == len(after)
        known = {n.lower() for n in told(before)}
        for a, b in zip(before, after, strict=True):
            if a.lower() in known and a[:1].isupper():
                # another word of the same look, the same for the text
                assert a != b and a.isupper() == b.isupper() and b.lower() not in {n.lower() for n in NAMES}
                assert fakes.setdefault((i, a.lower()), b.lower()) == b.lower()
            else:
                assert a == b
        each = {a: f for (d, a), f in fakes.items() if d == i}
        assert len(set(each.values())) == len(each) and done[i].n_entities == len(done[i].surrogates) == len(done[i].kinds)


def test_mentions_of_the_issue(spark):
    texts = ["Mr John Smith came. Later Smith said that John Smith was ill.", "Mrs Anna Lopez, Lopez", "Mr Smith's dog and SMITH", "Mr Smith came"]
    done = rows(spark, texts)
    given, surname = re.match(r"Mr (\w+) (\w+) came", done[0].text).groups()
    assert done[0].text == f"Mr {given} {surname} came. Later {surname} said that {given} {surname} was ill."
    assert re.fullmatch(r"Mrs \w+ (\w+), \1", done[1].text) and "Lopez" not in done[1].text
    # a surname has one surrogate in all texts
    assert done[2].text == f"Mr {surname}'s dog and {surname.upper()}" and done[3].text == f"Mr {surname} came"


def test_tokens_addresses_and_national_numbers(spark):
    found = {
        "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9PlFUP0THsR8U": "token",
        "ghp_abcdefghijklmnopqrstuvwxyzABCDEFGH12": "token", "xoxb-123456789012-abcDEF": "token", "glpat-abcDEF1234567890abcd": "token",
        "2001:0db8:85a3:0000:0000:8a2e:0370:7334": "ip6", "2001:db8::1": "ip6", "FE80::1FF:FE23:4567:890A": "ip6", "2001:db8::": "ip6",
        "030 1234567": "phone", "0171-2345678": "phone", "06131/123456": "phone",
    }
    texts = [f"see {value} here, {value}" for value in found]
    for i, r in rows(spark, texts).items():
        value = list(found)[i]
        a, b = re.fullmatch(r"see (.*) here, (.*)", r.text).groups()
        assert a == b != value and r.kinds == [found[value]] * 2 and len(a) == len(value)
        classes = lambda s: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", s)))
        assert classes(a) == classes(value)
        if found[value] == "phone":
            assert a[0] == "0"
        if found[value] == "ip6":
            assert re.fullmatch("[0-9A-Fa-f:]+", a)
    clean = ["at 12:30:45", "std::vector abc::def a::b ::", "0.12345678", "2024-01-02 10:20:30.123456", "ratio 1:2:3", "v0.1234 1.0123-45678", "sk-short eyJ.x.y", "Will you come in May?", "12:34:56:78:9a:bc"]
    assert {i: r.text for i, r in rows(spark, clean).items()} == dict(enumerate(clean))
