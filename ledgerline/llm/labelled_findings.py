"""Labelled findings from which the forest of the secret scan is trained.

Each line shows one candidate in its surroundings, made by rule from a seeded generator: real forms of credentials and
what is taken for them, such as checksums, numbers, host names, paths and placeholders.
"""

from __future__ import annotations

import random
import string

HEX, DIGITS, LETTERS = "0123456789abcdef", string.digits, string.ascii_letters
WORD_LETTERS = "aeinorstlduhcmgp"


def labelled_findings(copies: int = 60, seed: int = 5) -> list[tuple[str, int]]:
    """Lines of text with one candidate each, and 1 for a secret or 0 for none; the same on each call."""
    pick = random.Random(seed)

    def some(letters: str, n: int) -> str:
        return "".join(pick.choice(letters) for _ in range(n))

    def word() -> str:
        return some(WORD_LETTERS, pick.randint(2, 8))

    def words() -> str:
        return " ".join(word() for _ in range(pick.randint(1, 6)))

    def key() -> str:
        return pick.choice(["token", "api_key", "secret", "password", "access_key", "auth_token", "client_secret", "TOKEN", "API_KEY", "DB_PASS", "passphrase"])

    def assign(value: str) -> str:
        quote = pick.choice(["", "", "'", '"'])
        return quote + key() + quote + pick.choice([" = ", "=", ": ", ":", " => ", " := ", "      = "]) + pick.choice(['"{}"', "'{}'", "{}"]).format(value)

    def plain() -> str:
        return pick.choice([some(HEX, 40), some(HEX, 32), some(HEX.upper(), 40), some(LETTERS + DIGITS, 32), some(LETTERS + DIGITS + "+/", 40)])

    def human() -> str:
        """A password as people make them: a word, changed, with digits and marks."""
        start = word().title() + some(DIGITS, pick.randint(1, 3)) + word()
        return (start + pick.choice("&!%-_$#") + some(LETTERS + DIGITS, pick.randint(1, 4))).ljust(8, "7")

    def address(value: str) -> str:
        return f"{pick.choice(['postgres', 'https', 'mysql', 'amqp', 'redis'])}://{pick.choice([word(), 'admin', 'root', ''])}:{value}@{word()}{pick.choice(['', '.com', ':5432'])}/{word()}"

    def uuid() -> str:
        return "-".join(some(HEX, n) for n in (8, 4, 4, 4, 12))

    rows: list[tuple[str, int]] = []
    for _ in range(copies):
        secrets = [
            assign(plain()),
            assign(plain()),
            assign(some(LETTERS + DIGITS + "!%-_", pick.randint(12, 24))),
            "AKIA" + some(string.ascii_uppercase + DIGITS, 16),
            "ghp_" + some(LETTERS + DIGITS, 36),
            "xoxb-" + some(DIGITS, 12) + "-" + some(LETTERS + DIGITS, 24),
            "sk_live_" + some(LETTERS + DIGITS, 24),
            "eyJ" + some(LETTERS + DIGITS, 30) + ".eyJ" + some(LETTERS + DIGITS, 60) + "." + some(LETTERS + DIGITS + "-_", 43),
            "Authorization: Bearer " + some(LETTERS + DIGITS + "-_", 40),
            f"credential {some(LETTERS + DIGITS, 40)}",
            assign(human()),
            address(pick.choice([human(), some(LETTERS + DIGITS, pick.randint(8, 24))])),
            some(LETTERS, pick.randint(32, 44)),
            f"key {some(LETTERS, pick.randint(24, 40))}",
        ]
        others = [
            some(DIGITS, pick.randint(16, 20)),
            some(DIGITS, 16),
            f"{word()}.{word()}{pick.randint(1, 99)}.example.com",
            f"{pick.randint(100, 255)}.{pick.randint(100, 255)}.{pick.randint(100, 255)}.{pick.randint(10, 255)}",
            f"/{word()}/{word()}/{word()}{pick.randint(1, 99)}/{word()}.html",
            f"https://{word()}.com/{word()}/{word()}-{word()}-{pick.randint(1, 9999)}",
            f"sha256 {some(HEX, 64)}",
            f"checksum: {some(HEX, 32)}",
            f"commit {some(HEX, 40)}",
            f"id {uuid()}",
            uuid(),
            f"{word()}_{word()}_{word()}_{pick.randint(1, 99)}",
            f"{word()}-{word()}-{word()}-{pick.randint(1, 999)}-{word()}",
            f"{key()} = your_{word()}_key_{pick.randint(1, 9)}_here",
            f"{key()}: {'x' * pick.randint(12, 32)}1",
            f'{key()} = "{"0" * pick.randint(12, 32)}"',
            f"{key()}: {word()} {word()}",
            f"{pick.randint(1900, 2030)}-{pick.randint(10, 12)}-{pick.randint(10, 28)}T{pick.randint(10, 23)}-{pick.randint(10, 59)}",
            f"{word().title()}{word().title()}{word().title()}{pick.randint(1, 99)}",
            f"isbn {some(DIGITS, 13)}-{some(DIGITS, 4)}",
            address(pick.choice(["password", "your_password", "xxxxxxxx", "example", "changeme"])),
            f"{word()}{''.join(word().title() for _ in range(pick.randint(3, 6)))}()",
            "/".join(word().title() for _ in range(pick.randint(4, 6))),
            "-".join(word().title() for _ in range(pick.randint(4, 6))),
        ]
        rows += [(f"{words()} {s} {words()}", 1) for s in secrets] + [(f"{words()} {s} {words()}", 0) for s in others]
    return rows
