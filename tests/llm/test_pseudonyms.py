import datetime
import ipaddress
import random
import re

from helpers import documents
from hypothesis import given, settings
from hypothesis import strategies as st

from tradeledger.llm import pseudonyms as ps

TEXT = (
    "card 4191085147143418 or 4191-0851-4714-3418 tel +1 (756) 555-7633 or +49 30 1234567, mail ohntg.71@mail9.example.com "
    "ip 61.131.143.218 v 2.0. born 1987-03-12, 12.03.1987 03/12/1987 25/12/1987 ssn 123-45-6789 DE89 3704 0044 0532 0130 00"
)


def both():
    return ps.Pseudonymiser(b"k"), ps.Pseudonymiser(b"k", back=True)


def test_round_trip_and_no_value_left():
    there, back = both()
    made, counts = there.text(TEXT)
    assert back.text(made)[0] == TEXT
    assert counts == {"card": 2, "phone": 2, "ip": 1, "iban": 1, "ssn": 1, "date": 4, "email": 1}
    for value in ("4191085147143418", "555-7633", "ohntg", "61.131.143.218", "1987-03-12", "123-45-6789", "0532"):
        assert value not in made


def test_formats_and_checks_hold():
    made, _ = both()[0].text(TEXT)
    plain, dashed = re.findall(r"[0-9]{16}|(?:[0-9]{4}-){3}[0-9]{4}", made)
    digits = ps.digits_of(plain)
    assert ps.digits_of(dashed) == digits and ps.luhn(digits[:-1]) == int(digits[-1])  # equal values stay linked
    iso, german, us = re.search(r"born (\S+), (\S+) (\S+)", made).groups()
    day = datetime.date.fromisoformat(iso)
    assert german == day.strftime("%d.%m.%Y") and us == day.strftime("%m/%d/%Y") and day.year // 100 == 19
    account = re.search(r"DE[0-9 ]+", made).group().replace(" ", "")
    assert ps.iban_check("DE", account[4:]) == int(account[2:4])


def test_unassigned_areas_count_with_a_country_code():
    there, back = both()
    made, counts = there.text("+1 (017) 555-7713 and 117 555 7713")
    assert counts["phone"] == 1 and made.endswith(" and 117 555 7713") and made[4:7] != "017"
    assert ps.unassigned(ps.digits_of(made)[1:11]) and back.text(made)[0] == "+1 (017) 555-7713 and 117 555 7713"


def test_valid_values_before_further_groups():
    there, back = both()
    cases = {
        "ES91 2100 0418 4502 0005 1332 BIC CAIXESBB": ("iban", "0418"), "DE89 3704 0044 0532 0130 00 EUR": ("iban", "0044"),
        "ES91 2100 0418 4502 0005 1332 IBAN 2024 X": ("iban", "0418"), "ES9121000418450200051332 BIC": ("iban", "0418450"),
        "4111 1111 1111 1111 123": ("card", "1111 1111 1111"), "4111-1111-1111-1111 123 12/27": ("card", "1111-1111-1111"),
        "3782 822463 10005": ("card", "822463"), "3782-822463-10005 1234": ("card", "822463"),
        "me...ann@example.com": ("email", "ann@"), "so..ann.lee@example.com.": ("email", "ann.lee"),
    }
    for text, (kind, gone) in cases.items():
        made, counts = there.text(f"a {text} b")
        assert counts == dict.fromkeys(ps.KINDS, 0) | {kind: 1} and gone not in made, text
        assert back.text(made)[0] == f"a {text} b"
    assert there.text("me...ann@example.com")[0][5:] == there.text("ann@example.com")[0]  # equal values stay linked


def test_a_group_behind_a_card_never_joins_its_pseudonym():
    there, back = both()
    for i in range(300):
        head = f"4{i * 7919:014d}"
        text = f"{head}{ps.luhn(head)} {i:03d}"
        made, counts = there.text(text)
        assert counts["card"] == 1 and back.text(made)[0] == text
        assert made[:16] != text[:16]
        if ps.luhn(head + text[15] + text[17:19]) != int(text[19]):  # else 19 digits that are a number of their own
            assert made[:16] == there.text(text[:16])[0]  # equal values stay linked
        assert back.text(there.text(f"{text[:16]}{ps.MARK} x")[0])[0] == f"{text[:16]}{ps.MARK} x"


def test_numbers_before_other_values_and_more_formats():
    there, back = both()
    cases = {
        "+49 30 1234567 2024-05-01": {"phone": 1, "date": 1}, "+49 30 1234567 4111 1111 1111 1111": {"phone": 1, "card": 1},
        "(415)555-1234": {"phone": 1}, "030 1234567": {"phone": 1}, "01 42 68 53 00": {"phone": 1}, "020 7946 0958": {"phone": 1},
        "(030) 1234567 2024-05-01": {"phone": 1, "date": 1}, "030/1234567 and 0161 496 0000.": {"phone": 2},
        "josé.garcía@exämple.com": {"email": 1}, "jose\u0301@example.com": {"email": 1}, "Иван@почта.com": {"email": 1},
        "2001:db8::1": {"ip": 1}, "fe80:0:0:0:200:f8ff:fe21:67cf": {"ip": 1}, "::FFFF:1": {"ip": 1},
        "1 May 2024": {"date": 1}, "May 1, 2024": {"date": 1}, "1. Mai 2024": {"date": 1}, "12 de mayo de 2024": {"date": 1}, "3 décembre 1999": {"date": 1},
        "11/12/24": {"date": 1}, "+1 (212) 555-0147 10.0.0.1": {"phone": 1, "ip": 1},
    }
    for text, counted in cases.items():
        made, counts = there.text(f"a {text} b")
        assert counts == dict.fromkeys(ps.KINDS, 0) | counted, (text, made, counts)
        assert text not in made and back.text(made)[0] == f"a {text} b", (text, made)
    for text in ("12:30:45", "00:1A:2B:3C:4D:5E", "std::vector", "v1.2.24", "May 40, 2024", "31 June 2024", "01 23", "0.123456789", "1/2/3/24"):
        assert there.text(text) == (text, dict.fromkeys(ps.KINDS, 0)), text
    day = lambda t: re.sub(r"\D", "", there.text(t)[0])
    assert there.text("2024-05-07")[0][:4] == there.text("7 May 2024")[0][-4:] and day("05/07/2024")[-4:] == day("May 7, 2024")[-4:]


def planted(rng):
    """(kind, value) in many formats, made here and not by the patterns of the operator."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    number = rng.choice("3456") + d(14)
    number += str(next(c for c in range(10) if sum(sum(divmod(int(x) * (2 if i % 2 else 1), 10)) for i, x in enumerate(reversed(number + str(c)))) % 10 == 0))
    when = datetime.date(1950, 1, 1) + datetime.timedelta(days=rng.randrange(36000))
    body = d(18)
    check = 98 - int(body + "131400") % 97  # D and E as numbers, and two zeros
    account = f"DE{check:02d}{body}"
    word = lambda: "".join(rng.choice("abcdefghijkmnopqrsé") for _ in range(rng.randrange(2, 9)))
    return rng.choice([
        ("card", number), ("card", "-".join(number[i : i + 4] for i in range(0, 16, 4))), ("card", " ".join(number[i : i + 4] for i in range(0, 16, 4))),
        ("iban", account), ("iban", " ".join(account[i : i + 4] for i in range(0, 22, 4))),
        ("date", when.isoformat()), ("date", when.strftime("%d.%m.%Y")), ("date", when.strftime("%m/%d/%Y")), ("date", f"{when.day} {when:%B} {when.year}"),
        ("date", f"{when:%B} {when.day}, {when.year}"), ("ip", ".".join(str(rng.randrange(256)) for _ in range(4))),
        ("ip", str(ipaddress.IPv6Address(rng.getrandbits(128) | 1 << 124))), ("ssn", f"{rng.randrange(100, 600)}-{rng.randrange(10, 99)}-{rng.randrange(1000, 9999)}"),
        ("phone", f"+{rng.choice((33, 44, 49, 55))} {d(2)} {rng.randrange(1, 9)}{d(6)}"), ("phone", f"({rng.randrange(200, 999)}){rng.randrange(200, 999)}-{d(4)}"),
        ("phone", f"{rng.randrange(200, 999)}-{rng.randrange(200, 999)}-{d(4)}"), ("phone", f"0{rng.randrange(1, 9)} {d(2)} {d(2)} {d(2)} {d(2)}"),
        ("phone", f"0{rng.randrange(20, 99)} {rng.randrange(1, 9)}{d(6)}"), ("email", f"{word()}.{word()}{d(2)}@{word().replace('é', 'e')}x.example.org"),
    ])


def test_recall_over_formats_and_neighbours():
    """What an independent maker plants between words and other values is gone, and comes back."""
    rng = random.Random(8)
    there, back = both()
    met, kept = dict.fromkeys(ps.KINDS, 0), dict.fromkeys(ps.KINDS, 0)
    for _ in range(2500):
        own = [planted(rng) for _ in range(rng.randrange(1, 4))]
        text = "x " + "".join(v + rng.choice([" ", ", ", " and ", ".\n", "; ", ") "]) for _, v in own) + "end"
        made, _ = there.text(text)
        for kind, value in own:
            met[kind] += 1
            kept[kind] += value in made
    recall = {k: 1 - kept[k] / met[k] for k in ps.KINDS}
    assert min(recall.values()) >= 0.97, recall
    singles = [planted(rng)[1] for _ in range(500)]
    assert all(back.text(there.text(f"a {v} b")[0])[0] == f"a {v} b" for v in singles)


def test_both_dates_of_an_interval():
    there, back = both()
    for text in ("2024-05-01/2024-05-06", "01.05.2024-06.05.2024", "2024-05-01-2024-05-06", "05/21/2024-05/26/2024"):
        made, counts = there.text(f"from {text}.")
        first, second = text[:10], text[11:]
        assert counts["date"] == 2 and first not in made and second not in made
        assert made == f"from {there.text(first)[0]}{text[10]}{there.text(second)[0]}."
        assert back.text(made)[0] == f"from {text}."
    for text in ("12/2024-05-01", "1-2024-05-01", "2024-05-01-7", "2024-05-01/7", "1.2.2024.5"):
        assert there.text(text) == (text, dict.fromkeys(ps.KINDS, 0))


def test_invalid_values_stay():
    text = "4191085147143419 999.1.1.1 2021-02-29 000-12-3456 DE00370400440532013000 1.2.3.4.5 12345 v2.0 a@b 13/13/2020"
    assert both()[0].text(text) == (text, dict.fromkeys(ps.KINDS, 0))


def test_permutations_of_small_domains():
    net = ps.Feistel(b"key")
    for size in (1, 2, 3, 10, 97, 1000):
        seen = [net.permute(i, size, b"t") for i in range(size)]
        assert sorted(seen) == list(range(size))
        assert [net.permute(x, size, b"t", back=True) for x in seen] == list(range(size))
    assert [net.permute(i, 1000, b"t") for i in range(50)] != [net.permute(i, 1000, b"u") for i in range(50)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "É", " ", "\n", "@", ".", "-", "+1 ", "4111111111111111", "2020-01-31", "1.2.3.4", "x9@y.zz", "0", "/"]), max_size=30))
def test_any_text_is_handled(parts):
    text = "".join(parts)
    made, _ = both()[0].text(text)
    assert re.sub(r"[A-Za-z0-9.]", "", made) == re.sub(r"[A-Za-z0-9.]", "", text)


def test_awkward_rows(spark):
    docs = documents(spark, clashing=True)
    got = ps.pseudonymise(docs, "secret").collect()
    back = ps.pseudonymise(ps.pseudonymise(docs, "secret"), "secret", back=True)
    key = lambda r: (str(r["doc_id"]), str(r["text"]))
    assert sorted(map(key, back.collect())) == sorted(map(key, docs.collect()))
    nine = next(r for r in got if r["doc_id"] == 9)
    assert "4111 1111" not in nine["text"] and "2021-02-29" in nine["text"] and "ann.lee" not in nine["text"]
    assert (nine["n_card"], nine["n_date"], nine["n_email"], nine["size"]) == (1, 1, 1, "own size")
    assert {r["text"] for r in got if r["doc_id"] == 2} == {None}
    assert ps.pseudonymise(documents(spark, []), "secret").count() == 0
