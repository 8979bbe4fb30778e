"""A small labelled table for the personal-data field: sentences with marked spans.

Sentences and values are invented. Each marked sentence is filled several times with values drawn by a
seed; lines of made-up words without personal data, of the kinds that corpora hold (prose, capitals, signs,
numbers), teach what is to be left alone.
"""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

# fixed values: {kind} is a labelled span, <kind> a value without a label
SENTENCES = [
    "My name is {person} and I live in <word> .", "my name is {person} and I work at <Word> .", "Hello, I am Mr. {person} , nice to meet you.",
    "Please contact Mrs {person} for details of the <word> .", "Dear Dr. {person} , thank you for the <word> <word> .", "Signed by {person} on <date> .",
    "Patient name: {person} , admitted <date> .", "Customer name : {person}", "Name: {person}", "name={person}; visits=<small>", "Sincerely, Ms. {person}",
    "Mein Name ist {person} und ich bin <word> .", "Sehr geehrter Herr {person} , danke .", "Frau {person} hat am <date> angerufen .",
    "Je m'appelle {person} et je <word> .", "Madame {person} est <word> .", "Monsieur {person} , bonjour .", "Me llamo {person} y <word> .", "Señor {person} , buenos días .",
    "She lives at {address} in <Word> .", "Address: {address}", "Our address is {address} , <Word> .", "Ship to {address} before <date> .", "He moved to {address} last year.",
    "Wohnhaft in der {address} , <Word> .", "Adresse : {address} , <Word>", "Dirección: {address} , <Word>", "home address {address} , second floor",
    "Call me at {contact} after six.", "call {contact} now", "Phone: {contact}", "Tel. {contact} or by post", "tel: {contact}", "mobile {contact} ( evenings )", "Fax: {contact}",
    "My phone number is {contact} .", "Telefon {contact} , abends", "Téléphone : {contact}", "Teléfono: {contact} .", "You can reach me on {contact} , <word> <word> .",
    "Write to {spelled} for help.", "mail {spelled} please", "E-mail: {spelled}", "my email is {spelled} , thanks", "Contact {spelled} today.",
    "SSN: {ssn}", "My social security number is {ssn} .", "SSN {ssn} on file", "Passport no. {passport} issued <date>", "passport number: {passport}", "Passport {passport} expired .",
    "IBAN: {iban}", "Transfer it to IBAN {iban} by <date> .", "Account number {account} at the bank", "account no: {account}", "Driver's license {passport} , class <small>",
    "Kontonummer {account} bei der Bank", "Reisepass Nr. {passport} .", "tax id {ssn} , filed <date>", "Steuernummer {account}", "numéro de compte {account} .",
    # the same words without personal data
    "The name of the <word> is <word> .", "What is in a name? <Word> <word> .", "Call <word> when the <word> is <word> .", "Passport control is <word> .", "The address was <word> .",
    "The phone <word> for <small> minutes.", "a number of <word> , about <small>", "My account of the <word> <word> .", "Order <long> was shipped on <date> .", "Part no. <long> , batch <small>",
    "Serial <long>", "Version <small>.<small>.<small> of <date>", "It costs <small>.<small> euros ( <small> % ) .", "Between <year> and <year> the <word> grew by <small> .", "<Word> <Word> <word> <long> <word> .",
    "Page <small> of <small>", "at <small>:<small> on <date> <word> <word>", "id=<long>&x=<small>", "<Word> <Word> , <Word> and <Word> <word> .", "<WORD> !! <WORD> !! <WORD> !!", "See section <small>.<small> , figure <small> .",
    "<word> <ip> <word>", "<word> <mail> <word>", "<word> <intl> <word>", "<word> <long> <word> <word>", "<Word> <word> , <long>", "token = \" <hex> \" <word>", "https://www.<word>.example/<word>/<small>",
]
FIRST = "Anna Peter Maria Thomas Olga Ahmed Wei Lucía Jürgen Chloé Ivan Fatima Noah Emma Kofi Yuki Björn Inés Raj Sofia".split()
LAST = "Kowalski Smith Müller García Dubois Okafor Tanaka Novak Rossi Jensen Haddad Silva Berg Lefèvre Patel Moore Fischer Ortiz Vogel Quinn".split()
STREETS = ["Mill Road", "Station Street", "Oak Avenue", "High Street", "Park Lane", "King's Road", "Cedar Drive", "Elm St"]
STREETS_DE = ["Hauptstraße", "Bahnhofstraße", "Lindenweg", "Gartenstraße"]
STREETS_FR = ["rue de la Gare", "avenue Foch", "rue Victor", "boulevard Carnot"]
STREETS_ES = ["Calle Mayor", "Avenida del Sol", "Calle Luna"]
SYLLABLES = "an be ch de er ge ha in ka lo ment no on ou pa re st ti un ver wh ción äu é ß th ing ea le qui".split()
MARK = re.compile(r"([{<])(\w+)[}>]")
COMMON = ("the of and to in is on at by for with from that this it be are as a an or not der die das und von zu mit auf ein ist im den nicht "
          "le la les de et un une est pour en que du au il se el los las y por con su no del").split()
FILLS = 9        # times each sentence is filled
PLAIN = 1200     # lines of made-up words


def _word(rng: random.Random) -> str:
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))


def _number(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _value(kind: str, rng: random.Random) -> str:
    d = lambda n: _number(rng, n)
    title = lambda: _word(rng).capitalize()
    if kind == "person":
        first, last = rng.choice([rng.choice(FIRST), title()]), rng.choice([rng.choice(LAST), title()])
        return rng.choice([f"{first} {last}", f"{first} {last}", f"{first[0]}. {last}", f"{first} {title()} {last}", last])
    if kind == "address":
        n = str(rng.randint(1, 300))
        return rng.choice([f"{n} {rng.choice(STREETS)}", f"{n} {title()} {rng.choice(['Street', 'Road', 'Avenue', 'Lane', 'Drive'])}",
                           f"{rng.choice(STREETS_DE)} {n}", f"{n} {rng.choice(STREETS_FR)}", f"{rng.choice(STREETS_ES)} {n}"])
    if kind == "contact":
        return rng.choice([f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"0{d(2)} {d(4)} {d(4)}", f"0{d(3)}/{d(7)}", f"0{d(1)} {d(2)} {d(2)} {d(2)} {d(2)}", f"555-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}"])
    if kind == "spelled":
        a, b, c = _word(rng), _word(rng), rng.choice(["com", "org", "net", "de"])
        return rng.choice([f"{a} (at) {b} (dot) {c}", f"{a} at {b} dot {c}", f"{a} [at] {b} [dot] {c}", f"{a}(at){b}.{c}"])
    if kind == "ssn":
        return rng.choice([f"{d(3)}-{d(2)}-{d(4)}", f"{d(3)} {d(2)} {d(4)}"])
    if kind == "passport":
        return rng.choice("ABCXYZ") + rng.choice(["", rng.choice("KLM")]) + d(7)
    if kind == "iban":
        return rng.choice(["DE", "FR", "GB", "ES"]) + d(2) + rng.choice([" " + " ".join(d(4) for _ in range(4)), d(16)])
    if kind == "account":
        return d(rng.randint(7, 10))
    if kind == "date":
        return rng.choice([f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.{rng.randint(1950, 2025)}", f"{rng.randint(1950, 2025)}-0{rng.randint(1, 9)}-1{d(1)}", f"{rng.randint(1, 28)} May {rng.randint(1950, 2025)}"])
    if kind == "ip":
        return ".".join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == "mail":
        return f"{_word(rng)}.{d(2)}@{_word(rng)}.com"
    if kind == "intl":
        return rng.choice([f"+1 ({d(3)}) 555-{d(4)}", f"+{d(2)} {d(3)} {d(7)}"])
    return {"word": lambda: _word(rng), "Word": title, "WORD": lambda: _word(rng).upper(), "small": lambda: d(rng.randint(1, 3)),
            "long": lambda: d(rng.randint(5, 18)), "year": lambda: str(rng.randint(1900, 2030)), "hex": lambda: f"{rng.getrandbits(128):x}"}[kind]()


# fixed values: labels of the fills whose name is not a label
LABEL = {"spelled": "contact", "ssn": "number", "passport": "number", "iban": "number", "account": "number"}


def filled(sentence: str, rng: random.Random) -> tuple[str, list[tuple[str, int, int]]]:
    """One filled sentence and its spans; words may stand before and behind it."""
    text, found, at = "".join(f"{_word(rng)} " for _ in range(rng.choice([0, 0, 3]))), [], 0
    for m in MARK.finditer(sentence):
        text += sentence[at:m.start()]
        value = _value(m[2], rng)
        if m[1] == "{":
            found.append((LABEL.get(m[2], m[2]), len(text), len(text) + len(value)))
        text += value
        at = m.end()
    return text + sentence[at:] + "".join(f" {_word(rng)}" for _ in range(rng.choice([0, 0, 4]))), found


def _plain(rng: random.Random) -> str:
    words = [rng.choice([_word(rng), _word(rng), rng.choice(COMMON)]) for _ in range(rng.randint(3, 20))]
    kind = rng.randrange(6)
    if kind == 0:
        words = [w.upper() + rng.choice(["", "!!", ","]) for w in words]
    elif kind == 1:
        words = [rng.choice([w, w.capitalize()]) + rng.choice(["&&&", "%%%", "***", "", "#", "$$$"]) for w in words]
    elif kind == 2:  # one word again and again
        at = rng.randrange(len(words))
        words[at:at + 1] = [rng.choice([str.capitalize, str])(words[at]) + rng.choice(["", "", ",", "."])] * rng.randint(3, 12)
    else:  # sentences
        end = True
        for i, w in enumerate(words):
            w = w.capitalize() if end or rng.random() < 0.05 else w
            end = rng.random() < 0.25
            words[i] = w + ("." if end else rng.choice(["", "", "", ","]))
    if kind != 2:
        for _ in range(rng.choice([0, 0, 1, 2])):
            words.insert(rng.randrange(len(words)), rng.choice([_number(rng, rng.randint(1, 17)), _value("date", rng), _value("ip", rng), _value("intl", rng), _value("mail", rng), f'token = "{_value("hex", rng)}"']))
    return " ".join(words)


def examples(seed: int = 1, sentences: list[str] = SENTENCES, fills: int = FILLS, plain: int = PLAIN) -> list[tuple[str, list[tuple[str, int, int]]]]:
    rng = random.Random(seed)
    return [filled(s, rng) for s in sentences for _ in range(fills)] + [(_plain(rng), []) for _ in range(plain)]


def labelled_table(spark: SparkSession, seed: int = 1) -> DataFrame:
    """The table (text, spans)."""
    rows = [(t, [dict(kind=k, start=s, end=e) for k, s, e in found]) for t, found in examples(seed)]
    return spark.createDataFrame(rows, "text string, spans array<struct<kind:string,start:long,end:long>>")
