"""Texts with marked secrets and look-alikes, from which the secret scan learns.

Each text is prose with one thing put in: a secret as people leave it in code,
settings and logs, or something that looks like one and is none. What was put in
is the label, whatever the scan thinks of it. All values are made up.
"""

from __future__ import annotations

import random
from base64 import b64encode
from collections.abc import Callable
from dataclasses import dataclass

HEX = "0123456789abcdef"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
ALNUM = LETTERS + LETTERS.upper() + "0123456789"
CODES = LETTERS.upper() + "234567"
PROSE = (
    "the service reads its settings when it starts and writes a line for every request"
    " please rotate this before the release because the old value was shared with a partner"
    " we moved the job to another region last week and it has been slow since then"
    " nobody answers the phone after six so write a note to the team instead"
    " la maison est grande und der Hund ist alt pero la noche es larga"
).split()
NAMES = (
    "token secret password passwd api_key apikey access_key secret_key client_secret"
    " auth_token db_password private_key"
).split()
PLAIN_NAMES = "id name version host port path file width colour build commit checksum title page".split()
SOURCES = ["src1", "src2", "app/config.py", "deploy/values.yaml", "notes.md"]
TEST_SOURCES = ["tests/fixtures/keys.txt", "docs/example.md", "app/test_login.py"]


@dataclass
class Marked:
    text: str
    source: str
    start: int  # of the secret, in code points; as long as nothing if there is none
    end: int

    @property
    def secret(self) -> str:
        return self.text[self.start : self.end]


def _of(rng: random.Random, letters: str, least: int, most: int | None = None) -> str:
    return "".join(rng.choices(letters, k=rng.randint(least, most or least)))


def _assigned(rng: random.Random, name: str, value: str) -> tuple[str, str, str]:
    """Before the value, the value, and what follows it."""
    forms = [
        (f'{name} = "', '"'), (f"{name}=", ""), (f"{name}: ", ""),
        (f"export {name.upper()}=", ""), (f"'{name}': '", "',"), (f'"{name}":"', '"'),
    ]
    before, after = rng.choice(forms)
    if rng.random() < 0.1:  # a text in capitals
        before, value, after = before.upper(), value.upper(), after.upper()
    return before, value, after


def _word(rng: random.Random) -> str:
    return _of(rng, LETTERS, 4, 11)


def _email(rng: random.Random) -> str:
    return f"{_word(rng)}.{rng.randint(1, 99)}@mail{rng.randint(0, 9)}.example.com"


def _password(rng: random.Random) -> str:
    """Made by a person from a word, or drawn by a program from some letters."""
    if rng.random() < 0.4:
        return _word(rng)[:6] + _of(rng, "0123456789", 1, 4) + _of(rng, ALNUM + "!$%*", 2, 8) + "x"
    letters = rng.choice([ALNUM, ALNUM + "!@#$%*", HEX + "!#*", LETTERS + "0123456789", "0123456789!$abc"])
    return _of(rng, letters, 8, 18) + rng.choice("0123456789x")


def _groups(rng: random.Random) -> str:
    return "-".join(_of(rng, HEX, n) for n in (8, 4, 4, 4, 12))


Put = Callable[[random.Random], tuple[str, str, str]]

SECRETS: dict[str, Put] = {
    "hex value": lambda r: _assigned(r, r.choice(NAMES), _of(r, HEX, r.choice([32, 40, 64]))),
    "mixed value": lambda r: _assigned(r, r.choice(NAMES), _of(r, ALNUM, 20, 44)),
    "base64 value": lambda r: _assigned(r, r.choice(NAMES), b64encode(r.randbytes(r.randint(20, 44))).decode()),
    "password": lambda r: _assigned(r, r.choice(["password", "passwd", "pwd", "db_password"]), _password(r)),
    "cloud key": lambda r: ("", r.choice(["AKIA", "ASIA"]) + _of(r, CODES, 16), ""),
    "forge token": lambda r: ("", r.choice(["ghp_", "gho_", "glpat-"]) + _of(r, ALNUM, 36), ""),
    "chat token": lambda r: ("", "xoxb-" + _of(r, "0123456789", 12) + "-" + _of(r, ALNUM, 24), ""),
    "live key": lambda r: ("", "sk_live_" + _of(r, ALNUM, 24), ""),
    "bearer": lambda r: ("Authorization: Bearer ", _of(r, ALNUM, 28, 48), ""),
    "key behind a word": lambda r: (r.choice(["token ", "the secret key is "]), _of(r, HEX, 20, 39) + "7", ""),
}
LOOK_ALIKES: dict[str, Put] = {
    "card number": lambda r: ("", _of(r, "0123456789", 16), ""),
    "phone": lambda r: (f"+1 ({_of(r, '0123456789', 3)}) ", f"555-{_of(r, '0123456789', 4)}", ""),
    "address": lambda r: ("", ".".join(str(r.randint(0, 255)) for _ in range(4)), ""),
    "mail": lambda r: ("", _email(r), ""),
    "date": lambda r: ("", f"20{r.randint(10, 29)}-0{r.randint(1, 9)}-1{r.randint(0, 9)}T10:2{r.randint(0, 9)}:00", ""),
    "page": lambda r: ("see ", f"https://site{r.randint(1, 99)}.example.com/page/{r.randint(1, 9999)}", ""),
    "commit": lambda r: (r.choice(["commit ", "fixed in ", "revision "]), _of(r, HEX, 40), ""),
    "checksum": lambda r: _assigned(r, r.choice(["sha256", "md5", "checksum", "etag"]), _of(r, HEX, r.choice([32, 64]))),
    "request id": lambda r: _assigned(r, r.choice(["request_id", "trace", "id"]), _groups(r)),
    "placeholder": lambda r: _assigned(
        r, r.choice(NAMES), r.choice(["changeme", "your_token_here", "xxxxxxxxxxxx", "example-key-123", "<redacted>", "dummy_value1"])
    ),
    "reference": lambda r: _assigned(r, r.choice(NAMES), r.choice(["${%s}", "os.environ.%s", "$%s", "self.%s"]) % _word(r).upper()),
    "kind": lambda r: _assigned(r, r.choice(NAMES), r.choice(["string", "required", "optional", "None", "null", "boolean"])),
    "setting": lambda r: _assigned(r, r.choice(PLAIN_NAMES), r.choice([_word(r), str(r.randint(1, 99999)), f"{r.randint(1, 9)}.{r.randint(0, 20)}.1"])),
    "file": lambda r: _assigned(r, r.choice(PLAIN_NAMES), f"/static/{_word(r)}.{_of(r, HEX, 8)}.js"),
    "long word": lambda r: ("", "-".join(r.choices(PROSE, k=4)) + f"-{r.randint(1, 99)}", ""),
    "order number": lambda r: ("order ", _of(r, LETTERS.upper(), 2) + _of(r, "0123456789", 8), ""),
}


def marked_texts(each: int = 60, seed: int = 7) -> list[Marked]:
    """``each`` texts with every kind of secret and of look-alike, and half as
    many with a secret's form in a file of tests or examples, which is none."""
    rng = random.Random(seed)
    made = []

    def text(put: Put, secret: bool, source: str) -> None:
        before, value, after = put(rng)
        lead = " ".join(rng.choices(PROSE, k=rng.randint(0, 30)) + [_word(rng) for _ in range(4)])
        tail = " ".join(rng.choices(PROSE, k=rng.randint(0, 20)))
        head = f"{lead}{rng.choice([' ', chr(10), '. '])}{before}"
        start = len(head)
        end = start + len(value) if secret else start
        made.append(Marked(f"{head}{value}{after} {tail}", source, start, end))

    for put in SECRETS.values():
        for i in range(each):
            text(put, True, rng.choice(SOURCES))
            if i % 2:
                text(put, False, rng.choice(TEST_SOURCES))
    for put in LOOK_ALIKES.values():
        for _ in range(each):
            text(put, False, rng.choice(SOURCES + TEST_SOURCES))
    return made
