"""Labelled examples of personal data that the base patterns miss, made from seeded parameters and real windows of text.

Each example is a window of the corpus without personal data, with one value put between two of its words: in a plain
form, in a form that a pattern loses (spelled out, spaced, with other separators), or, unlabelled, a number or phrase
that only looks like one. Forms are drawn alike for every kind.
"""

from __future__ import annotations

import random

LETTERS, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Endings of addresses, and what stands before a value.
ENDINGS = ("com", "org", "net", "edu", "io", "de", "fr", "co.uk", "info")
LEADS = (
    "", "", "", "", "mail ", "e-mail: ", "contact ", "write to ", "call ", "tel. ", "phone: ", "fax ", "card ", "card no. ", "paid with ", "ip ",
    "host ", "server ", "from ", "at ", "(",
)
#: Signs for @ and for the dots of an address, for the dots of an IP, between the groups of a card and of a phone number, and before
#: the latter. The first of each is that of the base patterns.
AT_DOT = (("@", "."), (" at ", " dot "), (" AT ", " DOT "), (" (at) ", " (dot) "), (" [at] ", " [dot] "), (" @ ", " . "), ("(at)", "(dot)"), ("[at]", "[dot]"), ("@", " dot "))
IP_DOTS = (".", " . ", " dot ", "[.]", "(.)", " .", ". ")
CARD_SIGNS = (" ", ".", "/", "  ", " - ", "_", " . ")
PHONE_STARTS, PHONE_SIGNS = ("+", "00", "+ ", "00 "), (" ", "/", "-", ".", " / ", " - ")


def word(rng: random.Random, low: int, high: int, letters: str = LETTERS) -> str:
    return "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))


def email(rng: random.Random, form: int) -> str:
    at, dot = AT_DOT[form % len(AT_DOT)]
    local = word(rng, 2, 9) + rng.choice(("", "", word(rng, 1, 4, DIGITS), rng.choice(".._-") + word(rng, 2, 8)))
    host = word(rng, 3, 10) + rng.choice(("", "", "-" + word(rng, 2, 5), "." + word(rng, 3, 6)))
    return local.replace(".", rng.choice((".", dot))) + at + f"{host}.{rng.choice(ENDINGS)}".replace(".", dot)


def ip(rng: random.Random, form: int) -> str:
    return IP_DOTS[form % len(IP_DOTS)].join(str(rng.choice((rng.randint(0, 255), rng.randint(0, 20), 10, 192, 168))) for _ in range(4))


def card(rng: random.Random, form: int) -> str:
    digits = [rng.randint(0, 9) for _ in range(15)]
    doubled = sum((2 * d - 9 if d > 4 else 2 * d) if i % 2 == 0 else d for i, d in enumerate(digits))
    text = "".join(map(str, [*digits, -doubled % 10]))
    return CARD_SIGNS[form % len(CARD_SIGNS)].join(text[i : i + 4] for i in range(0, 16, 4))


def phone(rng: random.Random, form: int) -> str:
    # The form with both plain signs comes first.
    start, sign = PHONE_STARTS[form % len(PHONE_STARTS)], PHONE_SIGNS[form // len(PHONE_STARTS) % len(PHONE_SIGNS)]
    groups = [str(rng.randint(1, 999)), str(rng.randint(20, 9999)), *(word(rng, 3, 4, DIGITS) for _ in range(rng.randint(1, 2)))]
    if rng.random() < 0.25:
        groups[1] = f"({groups[1]})"
    return start + sign.join(groups)


def other(rng: random.Random, form: int) -> str:
    """What looks like personal data but is none."""
    number = lambda low, high: str(rng.randint(low, high))
    year, two = number(1900, 2030), lambda: f"{rng.randint(1, 28):02d}"
    return (
        f"{year}-{two()}-{two()}", f"{two()}.{two()}.{year}", f"{two()}/{two()}/{year}", f"{two()}:{two()}:{two()}", f"v{number(0, 9)}.{number(0, 20)}.{number(0, 9)}",
        f"{number(1, 999)},{number(100, 999)}.{two()}", number(10**8, 10**13), f"pages {number(1, 90)}-{number(91, 300)}", f"{year}-{number(1900, 2030)}",
        f"978-{number(0, 9)}-{number(10, 99)}-{number(100000, 999999)}-{number(0, 9)}", f"the dot {word(rng, 3, 8)}", f"at the {word(rng, 3, 8)}", f"a {word(rng, 3, 8)} dot plot",
        f"{number(1, 9)} . {number(1, 9)} . {number(1, 9)}", f"{number(1, 99)} {number(1, 99)} {number(1, 99)} {number(1, 99)}", f"@{word(rng, 3, 9)}", f"00{number(1, 99)}", f"+{number(1, 99)}",
        f"{number(100, 999)} {number(1000, 9999)}", f"{word(rng, 3, 8)} at {word(rng, 3, 8)}. {word(rng, 3, 6)}",
    )[form % 20]


KINDS = (email, ip, card, phone)


def put_in(rng: random.Random, carrier: str, value: str) -> tuple[str, int]:
    """The carrier with the value between two of its words, and where the value begins."""
    gaps = [0, len(carrier), *(i for i, c in enumerate(carrier) if c == " ")]
    at = rng.choice(gaps)
    before = carrier[:at] + (" " if at and carrier[at - 1 : at] != " " else "")
    after = carrier[at:]
    end = rng.choice(("", "", ".", ",", ")")) + (" " if after and after[0] != " " else "")
    return before + value + end + after, len(before)


def examples(carriers: list[str], count: int, width: int, seed: int) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """``count`` windows of at most ``width`` characters with their labelled spans; the carriers are taken in turn."""
    rng = random.Random(seed)
    made = []
    for i in range(count):
        kind = i % (len(KINDS) + 1)
        form = rng.randrange(1 << 16)
        value = (KINDS[kind] if kind < len(KINDS) else other)(rng, form)
        lead = rng.choice(LEADS)
        text, at = put_in(rng, carriers[i // (len(KINDS) + 1) % len(carriers)] if carriers else "", lead + value)
        at += len(lead)
        # Any window that holds the whole value.
        first = rng.randint(max(0, at + len(value) - width), max(0, min(at, len(text) - width)))
        made.append((text[first : first + width], [(kind, at - first, at - first + len(value))] if kind < len(KINDS) else []))
    return [(text, spans) for text, spans in made if all(0 <= s and e <= len(text) for _, s, e in spans)]
