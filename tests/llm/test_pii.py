"""Pseudonyms: formats and checks hold, equal values stay linked, everything else stays."""

import re

from tidemark.llm import pii


def luhn(text):
    total = 0
    for i, c in enumerate(reversed(re.sub(r"\D", "", text))):
        v = int(c)
        total += v if i % 2 == 0 else v * 2 - 9 * (v > 4)
    return total % 10 == 0


def mod97(text):
    t = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97


def run(docs, *texts, key="k"):
    return [r.text for r in sorted(pii.pseudonyms(docs(*enumerate(texts)), key).collect(), key=lambda r: r.doc_id)]


def test_every_kind_keeps_its_format(docs):
    card, spaced, phone, mail, ip, iso, day, ssn, iban = run(
        docs, "4539148803436467", "4539 1488-0343 6467", "+1 (974) 555-3436", "The.99@mail9.example.com", "83.229.25.121", "1985-02-28", "28/02/1985", "123-45-6789",
        "GB82 WEST 1234 5698 7654 32")
    assert luhn(card) and len(card) == 16 and card != "4539148803436467"
    assert re.fullmatch(r"\d{4} \d{4}-\d{4} \d{4}", spaced) and re.sub(r"\D", "", spaced) == card
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", phone) and phone != "+1 (974) 555-3436"
    assert re.fullmatch(r"[a-z0-9]{3}\.[a-z0-9]{2}@mail9\.example\.com", mail) and not mail.startswith("the.99")
    assert all(0 <= int(p) <= 255 for p in ip.split(".")) and ip != "83.229.25.121"
    assert re.fullmatch(r"\d{4}-\d\d-\d\d", iso) and "/".join(reversed(iso.split("-"))) == day
    assert re.fullmatch(r"\d{3}-\d\d-\d{4}", ssn) and ssn != "123-45-6789"
    assert mod97(iban) == 1 and re.fullmatch(r"GB\d\d WEST \d{4} \d{4} \d{4} \d\d", iban)


def test_equal_values_link_and_keys_differ(docs):
    a, b = run(docs, "mail a.b@x.org, card 4539148803436467$$$", "again A.B@x.org! and 4539148803436467")
    assert re.search(r"\S+@x.org", a)[0].rstrip(",") == re.search(r"\S+@x.org", b)[0] and re.search(r"\d{16}", a)[0] == re.search(r"\d{16}", b)[0]
    assert run(docs, "4539148803436467", key="other") != run(docs, "4539148803436467")


def test_values_beside_other_numbers(docs):
    cards, phone = run(docs, "4539148803436467 12 and 4539148803436467 4539148803436467.", "call +19745553436 now")
    assert "4539148803436467" not in cards and cards[16:19] == " 12" and "9745553436" not in phone


def test_permutation_is_one_to_one(docs):
    dates = [f"{y}-{m:02d}-{d:02d}" for y in (1900, 1999, 2099) for m in range(1, 13) for d in (1, 15, 28)]
    assert len(set(run(docs, *dates))) == len(dates)
    numbers = [f"555 010 {i:04d}" for i in range(300)]
    assert len(set(run(docs, *numbers))) == 300


def test_what_fails_its_check_stays(docs):
    texts = ["4539148803436468", "999.1.1.1", "2024-13-01", "000-12-3456", "GB00 WEST 1234 5698 7654 32", "plain words, no 12 3", "", "v1.2.3.4.5 a@b 1.2.", None]
    assert run(docs, *texts) == texts


def test_long_text_repeated_rows_and_empty_table(docs):
    text = "word " * 20_000 + "83.229.25.121" + " x" * 20_000
    (out,) = run(docs, text)
    assert out.startswith("word " * 20_000) and out.endswith(" x" * 20_000) and "83.229.25.121" not in out
    frame = docs((1, "1.2.3.4"), (1, "1.2.3.4"))
    assert len({r.text for r in pii.pseudonyms(frame, "k").collect()}) == 1
    assert pii.pseudonyms(frame.limit(0), "k").count() == 0
