"""Personal data: generated candidates, boosted trees over format and context, calibrated thresholds.

DataFrame functions only on the main path. The trees are fitted on the driver over counts of feature patterns, of
which there are at most ``2 ** len(FEATURES)`` whatever the number of rows.
"""

from __future__ import annotations

import functools
import math
import operator
import random
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slidemill.llm.common import checkpoint

BITS = 1 << 24  # of the marks of texts with spans
BLOCK = 1024  # code points of the pieces in which a text is redacted

#: Generators: kind -> (pattern, cheap test of the text). The first four are the base patterns; each starts only where a
#: match can start and never gives back what it took, so a scan is linear in the text.
BASE = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", None),
    "card": (r"[0-9](?:[\x20-]?+[0-9])++", None),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
}
LOOSE = {
    "email_written": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:(?:\x20?[\[(]dot[\])]\x20?|\.|\x20dot\x20)[A-Za-z0-9-]{2,}+)++", None),
    "email_spelt": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20at\x20[A-Za-z0-9-]++(?:\x20dot\x20[A-Za-z0-9-]++)++", " dot "),
    "phone_plain": (r"(?<![0-9A-Za-z+])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9A-Za-z])", None),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", None),
    "phone_any": (r"(?<![0-9A-Za-z+.,/-])\(?[0-9]{2,4}\)?(?:[\x20.-][0-9]{2,4}){2,4}(?![0-9A-Za-z])", None),
    "ipv6": (
        r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}|(?:[0-9A-Fa-f]{1,4}:){1,7}:)(?![0-9A-Za-z:])", None,
    ),
    "iban": (r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])", None),
    "passport": (r"(?<![A-Za-z0-9.,-])[A-Z]{0,2}[0-9]{6,9}(?![A-Za-z0-9-]|[.,][0-9])", None),
    "secret_pair": (
        r"(?i)(?<![A-Za-z])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|bearer|credentials?|private[_-]?key)"
        r"(?:[_-][A-Za-z]++)?[\"']?\x20{0,2}[:=]>?\x20{0,2}[\"']?[^\s\"',;<>]{4,}+", None,
    ),
    "key_run": (r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{24,}+={0,2}(?![A-Za-z0-9])", None),
    "key_prefixed": (
        r"(?<![A-Za-z0-9_-])(?:[A-Za-z]++[_-](?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{16,}+|A[A-Z]{3}[A-Z0-9]{16}(?![A-Za-z0-9_-])|AIza[A-Za-z0-9_-]{30,}+)", None,
    ),
    "key_dotted": (r"(?<![A-Za-z0-9_.-])eyJ[A-Za-z0-9_-]{6,}+\.[A-Za-z0-9_-]{6,}+\.[A-Za-z0-9_-]{6,}+", "eyJ"),
    "key_block": (
        r"-----BEGIN\x20(?:[A-Z]++\x20){0,4}?PRIVATE\x20KEY(?:\x20BLOCK)?-----(?:[^-]|-(?!-))*+-----END\x20(?:[A-Z]++\x20){0,4}?PRIVATE\x20KEY(?:\x20BLOCK)?-----", "PRIVATE KEY",
    ),
    "url_login": (r"(?<![A-Za-z0-9+.-])[A-Za-z0-9+.-]++://[^\s/:@\"']++:[^\s/@\"']++@[A-Za-z0-9.-]++", "://"),
    "person": (r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.?\x20[A-Z][a-z]++(?:\x20[A-Z][a-z]++){0,2}", None),
    "address": (r"(?<![0-9A-Za-z.,-])[0-9]{1,5}[A-Za-z]?\x20(?:[A-Z][a-z]++\x20){1,3}(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Dr|Boulevard|Blvd)(?![A-Za-z])", None),
}
#: The tests that let a loose pattern loose on a text: cheap, and true wherever the pattern can match.
TESTS = {
    "email_written": r"[\[(]at[\])]", "phone_plain": r"[0-9][)\x20.-]\x20?[0-9]{3}", "phone_any": r"[0-9][)]?[\x20.-][0-9]{2,4}[\x20.-][0-9]{2}", "ssn": r"[0-9]-[0-9]{2}-[0-9]", "iban": r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}",
    "ipv6": r"[0-9A-Fa-f]::|[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:[0-9A-Fa-f]{1,4}:", "passport": r"[0-9]{6}", "secret_pair": r"(?i)pass|pwd|secret|token|key|auth|bearer|credential", "key_run": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24}",
    "key_prefixed": r"[A-Za-z][_-][A-Za-z0-9_-]{16}|A[A-Z]{3}[A-Z0-9]{16}|AIza", "person": r"(?:Mr|Mrs|Ms|Dr|Prof)\.?\x20[A-Z][a-z]", "address": r"[0-9][A-Za-z]?\x20[A-Z][a-z]+\x20[A-Z]",
}
#: The kind under which a loose candidate is reported.
REPORTED = {
    "email_written": "email", "email_spelt": "email", "phone_plain": "phone", "phone_any": "phone", "ssn": "ssn", "ipv6": "ip", "iban": "iban", "passport": "passport", "secret_pair": "secret", "key_run": "secret",
    "key_prefixed": "secret", "key_dotted": "secret", "key_block": "secret", "url_login": "secret", "person": "person", "address": "address",
}
ORDER = {k: i for i, k in enumerate([*BASE, "ssn", "iban", "secret", "person", "address", "passport"])}

FEATURES = (
    "few_digits", "phone_digits", "many_digits", "has_paren", "has_dash", "has_space", "has_dot", "has_at", "upper",
    "cue", "counter_cue", "decimal_around", "date_like", "assigned", "quoted", "hex", "mixed", "long", "digit", "login", "titled", "names", "street", "near_word",
    "calendar", "ssn_shape", "as_phone", "as_ssn", "prefixed", "dotted", "block", "colons", "domain", "password", "passport",
)
CUE = r"(?i)(call|phone|tel|fax|mobile|cell|mail|contact|reach|write|ssn|social|iban|account|bank|card|key|token|secret|credential|signed|lives?|address|home|resid\w*|patient|client)[^A-Za-z]{0,4}(?:\w+[^A-Za-z]{0,3}){0,2}$"
COUNTER = r"(?i)(version|isbn|order|invoice|build|page|section|chapter|year|item|no|part|code|serial|id|sha\d*|md5|checksum|commit|digest|revision|uuid|model|batch)[^A-Za-z]{0,4}$"
# How well-known issuers begin their keys, and common ends of host names.
ISSUED = r"^(?:gh[pousr]_|github_pat_|glpat-|hf_|npm_|pypi-|sk-|[spr]k_(?:live|test)_|xox[abeprs]-|A(?:KIA|SIA)[A-Z0-9]|AIza)"
DOMAIN = r"[\x20.](?:com|org|net|edu|gov|info|io|de|fr|es|uk)$"
#: A day of this or the last century, year first or last.
CALENDAR = r"^(?:(?:19|20)[0-9]{2}([\x20.-])(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12][0-9]|3[01])|(?:0?[1-9]|[12][0-9]|3[01])([\x20.-])(?:0?[1-9]|[12][0-9]|3[01])\2(?:19|20)[0-9]{2})(?![0-9])"
#: Values of a key that are words about it rather than the key.
PLAIN_VALUE = r"(?i)[:=]>?\x20{0,2}[\"']?(?:[a-z]{4,12}|[0-9]{1,6}|[<{$%\[(*].*)$"


def candidates(docs: DataFrame) -> DataFrame:
    """One row for each candidate and one (null kind) for each document: ``row, doc_id, digest, kind, nth, gap, hit, before, after``.

    ``gap`` is the number of code points between the previous match of the kind and this one. The text itself does
    not leave this narrow stage.
    """
    t = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    t = t.withColumn("digest", F.xxhash64("text"))  # here, below the generator: once for a text, not once for a match
    # one sign or digit is quickly looked for, and most texts hold none
    has = lambda *signs: functools.reduce(operator.or_, (F.contains("text", F.lit(x)) for x in signs))
    t = t.withColumn("digit", F.rlike("text", F.lit("[0-9]")))
    t = t.withColumn("digits", F.col("digit") & (F.rlike("text", F.lit(r"[0-9][^A-Za-z]{0,3}[0-9][^A-Za-z]{0,3}[0-9]")) | F.rlike("text", F.lit(r"[0-9]\.[0-9]"))))
    first = dict.fromkeys(("ip", "card", "phone_plain", "phone_any", "ssn"), F.col("digits")) | dict.fromkeys(("iban", "key_run", "address"), F.col("digit"))
    first |= {"secret_pair": has(":", "="), "person": has("Mr", "Ms", "Dr", "Prof"), "email_written": has("[at]", "(at)", "[at)", "(at]"), "ipv6": has(":"), "passport": F.col("digit") & has("passport", "Passport", "PASSPORT"), "key_prefixed": F.col("digit")}
    tests = {"ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?+[0-9]){15}"} | TESTS
    for kind, (pattern, sign) in (BASE | LOOSE).items():
        ask = F.contains("text", F.lit(sign)) if sign else F.rlike("text", F.lit(tests[kind]))
        ask = first[kind] & ask if kind in first else ask
        t = t.withColumn(f"m_{kind}", F.when(ask, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))))
        t = t.withColumn(f"p_{kind}", F.when(F.size(f"m_{kind}") > 0, F.split("text", pattern, -1)))

    def found(kind: str) -> Column:
        p, m = F.col(f"p_{kind}"), F.col(f"m_{kind}")
        at = lambda i: F.struct(
            F.lit(kind).alias("kind"), i.alias("nth"), F.char_length(F.get(p, i)).alias("gap"), F.get(m, i).alias("hit"),
            F.substring(F.get(p, i), -40, 40).alias("before"), F.substring(F.get(p, i + 1), 1, 8).alias("after"),
        )
        none = F.array().cast("array<struct<kind:string,nth:int,gap:int,hit:string,before:string,after:string>>")
        return F.when(F.size(m) > 0, F.transform(F.sequence(F.lit(0), F.size(m) - 1), at)).otherwise(none)

    end = F.array(F.struct(*(F.lit(None).cast(k).alias(n) for n, k in (("kind", "string"), ("nth", "int"), ("gap", "int"), ("hit", "string"), ("before", "string"), ("after", "string")))))
    return t.select("row", "doc_id", "digest", F.explode(F.concat(*map(found, BASE | LOOSE), end)).alias("c")).select("row", "doc_id", "digest", "c.*")


def luhn(digits: Column) -> Column:
    at = lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
    twice = lambda x: F.when(x > 4, 2 * x - 9).otherwise(2 * x)
    total = F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), lambda a, i: a + F.when(i % 2 == 0, twice(at(i))).otherwise(at(i)))
    return total % 10 == 0


def is_base() -> Column:
    """Whether a match of a base pattern holds; failing ones are dropped without another try."""
    digits = F.regexp_replace("hit", "[^0-9]", "")
    n = F.char_length(digits)
    octet = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return F.coalesce(
        F.when(F.col("kind") == "email", True)
        .when(F.col("kind") == "ip", F.rlike("hit", F.lit(rf"^{octet}\.{octet}\.{octet}\.{octet}$")))
        .when(F.col("kind") == "card", F.when(n.between(16, 19), luhn(digits)).otherwise(False))
        .when(F.col("kind") == "phone", n.between(8, 15)),
        F.lit(False),
    )


def feature_bits() -> Column:
    """Format and context of a loose candidate as a bit pattern."""
    n = F.char_length(F.regexp_replace("hit", "[^0-9]", ""))
    tests = {
        "few_digits": n < 7, "phone_digits": n.between(9, 11), "many_digits": n > 11,
        "has_paren": F.contains("hit", F.lit("(")), "has_dash": F.contains("hit", F.lit("-")), "has_space": F.contains("hit", F.lit(" ")), "has_dot": F.contains("hit", F.lit(".")),
        "has_at": F.rlike("hit", F.lit(r"[\[(]at[\])]")), "upper": F.rlike("hit", F.lit("^[A-Z]{2}[0-9]{2}")),
        "cue": F.rlike("before", F.lit(CUE)), "counter_cue": F.rlike("before", F.lit(COUNTER)),
        "decimal_around": F.rlike("before", F.lit(r"[0-9][.,/:-]?\x20?$")) | F.rlike("after", F.lit(r"^[.,/:-]?\x20?[0-9]")),
        "date_like": F.rlike("hit", F.lit(r"^(?:19|20)[0-9]{2}[ .-]")) | F.rlike("hit", F.lit(r"[ .-](?:19|20)[0-9]{2}$")),
        "assigned": F.rlike("hit", F.lit(r"^[A-Za-z_-]+[\"']?\x20{0,2}[:=]")), "quoted": F.rlike("hit", F.lit(r"[\"']")) | F.rlike("before", F.lit(r"[\"']$")),
        "hex": F.rlike("hit", F.lit(r"[0-9a-fA-F]{24}")), "mixed": F.rlike("hit", F.lit("[a-z]")) & F.rlike("hit", F.lit("[A-Z]")) & F.rlike("hit", F.lit("[0-9]")),
        "long": F.char_length("hit") >= 24, "digit": F.rlike("hit", F.lit("[0-9]")), "login": F.contains("hit", F.lit("://")), "titled": F.rlike("hit", F.lit(r"^(?:Mr|Mrs|Ms|Dr|Prof)\b")),
        "names": F.rlike("hit", F.lit(r"[A-Z][a-z]+\x20[A-Z][a-z]+$")), "street": F.rlike("hit", F.lit(r"(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Dr|Boulevard|Blvd)$")), "near_word": F.rlike("hit", F.lit(PLAIN_VALUE)),
        "calendar": F.rlike("hit", F.lit(CALENDAR)), "ssn_shape": F.rlike("hit", F.lit("^[0-9]{3}-[0-9]{2}-[0-9]{4}$")), "as_phone": F.col("kind").isin("phone_plain", "phone_any"), "as_ssn": F.col("kind") == "ssn",
        "prefixed": F.rlike("hit", F.lit(ISSUED)), "dotted": F.col("kind") == "key_dotted", "block": F.col("kind") == "key_block", "colons": F.rlike("hit", F.lit("(?:[0-9A-Fa-f]{1,4}:+){3}")), "domain": F.rlike("hit", F.lit(DOMAIN)),
        "password": F.rlike("hit", F.lit(r"^(?i)(?:pass(?:word|wd|phrase|code)?|pwd)=[^\s]")), "passport": F.rlike("before", F.lit(r"(?i)passport[^0-9]{0,24}$")),
    }
    bits = F.lit(0).cast("long")
    for i, name in enumerate(FEATURES):
        bits = bits + F.when(tests[name], F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
    return bits


def seed_templates(rng: random.Random) -> list[tuple[str, str, Callable[[], str]]]:
    """``(set, kind, snippet)``: personal formats against look-alikes (kind ''). Templates of ``fit``, ``calibrate`` and ``test`` are different ones."""
    of = lambda alphabet, k: "".join(rng.choice(alphabet) for _ in range(k))
    d = lambda k: of("0123456789", k)
    hex_ = lambda k: of("0123456789abcdef", k)
    h = lambda: of("123456789abcdef", 1) + hex_(3)
    mixed = lambda k: "aZ7" + of("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789", k)
    caps = lambda k: "7" + of("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k)
    w = lambda: of("abcdefghijklmnoprstuvw", rng.randint(4, 9))
    n = lambda: w().capitalize()
    c = lambda *x: rng.choice([*x, f"{w()} {w()}"])
    st = lambda *x: rng.choice(x)
    y, mo, da = (lambda: f"{st(19, 20)}{d(2)}"), (lambda: f"{rng.randint(1, 12):02}"), (lambda: f"{rng.randint(1, 28):02}")
    pem = lambda what: f"-----BEGIN {what}-----\n{mixed(61)}\n{mixed(40)}=\n-----END {what}-----"
    good = {
        "fit": {
            "phone": (lambda: f"{c('call', 'phone:', 'fax')} ({d(3)}) {d(3)}-{d(4)}", lambda: f"{st('tel.', 'mobile', 'contact')} {d(3)} {d(3)} {d(4)}", lambda: f"{st('call', 'tel')} {d(2)} {d(2)} {d(2)} {d(2)} {d(2)}"),
            "email": (lambda: f"{c('mail', 'write to')} {w()} (at) {w()}.com", lambda: f"{w()} (at) {w()} dot {st('com', 'org')}", lambda: f"{c('mail', 'reach')} {w()}{st('', '.x', '_y')} at {w()} dot {st('com', 'net')}", lambda: f"{w()}.{w()} at {w()} dot {st('org', 'de')}"),
            "ssn": (lambda: f"{c('ssn', 'ssn:')} {d(3)}-{d(2)}-{d(4)}", lambda: f"my SSN is {d(3)}-{d(2)}-{d(4)}"),
            "ip": (lambda: f"{w()} {':'.join(h() for _ in range(8))}", lambda: f"{st('host', 'from')} 2001:db8::{h()}:{h()}"),
            "iban": (lambda: f"{c('iban', 'account')} {st('DE', 'FR')}{d(2)} {d(4)} {d(4)} {d(4)} {d(4)} {d(2)}",),
            "passport": (lambda: f"passport no. {st('X', 'K', 'AB')}{d(7)}", lambda: f"passport number {d(9)}"),
            "secret": (
                lambda: f"password = {w()}{d(2)}!{w()}", lambda: f'token: "{hex_(32)}"', lambda: f"api_key={mixed(28)}", lambda: f"the key {mixed(37)}", lambda: f"{st('https', 'ftp')}://{w()}:{w()}{d(2)}@{w()}", lambda: f"pwd={w()}", lambda: f"passwd={w()}",
                lambda: f"{w()} ghp_{of('abcdefghijklmnop0123456789', 35)}7", lambda: f"{w()} sk-{st('', 'proj-')}{mixed(37)}", lambda: f"{st('key id', 'item', w())} AKIA{caps(15)}", lambda: f"{st('id', 'commit', 'code')} ghp_{mixed(33)}", lambda: f"{st('https', 'redis')}://{w()}:{w()}-{w()}@{w()}", lambda: f"{w()}+{w()}://{w()}:{w()}@{w()}", lambda: f"{w()} eyJ{mixed(17)}.eyJ{mixed(22)}.{mixed(40)}", lambda: pem("RSA PRIVATE KEY"),
            ),
            "person": (lambda: f"{st('Mr.', 'Dr.')} {n()} {n()}",), "address": (lambda: f"{st('lives at', 'address')} {d(2)} {n()} {st('Street', 'Road')}",),
        },
        "calibrate": {
            "phone": (lambda: f"{c('reach', 'cell')} {d(3)}-{d(3)}-{d(4)}", lambda: f"{st('phone', 'call us')} {d(3)}.{d(3)}.{d(4)}", lambda: f"{st('mobile', 'phone')} {d(3)} {d(2)} {d(2)} {d(3)}"),
            "email": (lambda: f"{c('contact', 'mail')} {w()}[at]{w()} [dot] org", lambda: f"{w()}{st('', '.a', '-b')} at {w()} dot {w()} dot {st('org', 'io')}"),
            "ssn": (lambda: f"{c('social security')} {d(3)}-{d(2)}-{d(4)}",), "ip": (lambda: f"{w()} fe80::{h()}:{h()}:{h()}:{h()}", lambda: f"{w()} {':'.join(h().upper() for _ in range(8))}"),
            "iban": (lambda: f"{c('bank')} {st('ES', 'GB')}{d(2)}{d(4)}{d(4)}{d(4)}{d(4)}",), "passport": (lambda: f"her passport is {st('C', 'YA')}{d(6)}", lambda: f"Passport: {d(8)}"),
            "secret": (
                lambda: f"pwd: {mixed(9)}", lambda: f'secret = "{mixed(30)}"', lambda: f"auth_token => {hex_(40)}", lambda: f"credential {mixed(45)}", lambda: f"{st('mysql', 'amqp')}://{w()}:{mixed(8)}@{w()}-{w()}", lambda: f"password={w()}",
                lambda: f"{w()} xoxb-{d(11)}-{mixed(21)}", lambda: f"{st('id', 'build', w())} glpat-{mixed(17)}", lambda: f"{w()} AIza{mixed(32)}", lambda: f"{w()} eyJ{mixed(30)}.{mixed(60)}.{mixed(20)}", lambda: pem("PRIVATE KEY"),
            ),
            "person": (lambda: f"patient {st('Mrs.', 'Prof.')} {n()} {n()}",), "address": (lambda: f"home {d(3)} {n()} {n()} {st('Avenue', 'Lane')}",),
        },
        "test": {
            "phone": (lambda: f"{st('tel', 'fax')} ({d(3)}) {d(3)} {d(4)}",), "email": (lambda: f"reach me {w()} [at] {w()}.net", lambda: f"{w()}_{w()} at {w()} dot {w()} dot com", lambda: f"ask {w()} [at] {w()} [dot] io"),
            "ssn": (lambda: f"social {d(3)}-{d(2)}-{d(4)}",), "ip": (lambda: f"address {h()}:{h()}::{h()}:{h()}",), "iban": (lambda: f"account FR{d(2)} {d(4)} {d(4)} {d(4)} {d(4)}",), "passport": (lambda: f"holder of passport {st('P', 'GB')}{d(7)}",),
            "secret": (
                lambda: f'"access_key": "{mixed(33)}"', lambda: f"passphrase: {w()}-{mixed(6)}", lambda: f'token = "{hex_(40)}"', lambda: f"postgres://{w()}:{mixed(10)}@{w()}", lambda: f"passphrase={w()}", lambda: f"{w()} hf_{mixed(31)}",
                lambda: f"{w()} ASIA{caps(15)}", lambda: f"{w()} sk_live_{mixed(21)}", lambda: f"cookie eyJ{mixed(24)}.eyJ{mixed(90)}.{mixed(40)}", lambda: pem("EC PRIVATE KEY"),
            ),
            "person": (lambda: f"client Ms. {n()} {n()}",), "address": (lambda: f"resides {d(4)} {n()} {st('Blvd', 'Drive')}",),
        },
    }
    bad = {
        "fit": (
            lambda: f"version {d(2)}.{d(3)}.{d(3)}", lambda: f"order {d(3)} {d(3)} {d(3)}", lambda: f"isbn {d(3)}-{d(4)}-{d(4)}-{d(1)}", lambda: f"{w()} 20{d(2)} {d(3)} {d(4)}", lambda: f"{w()} {d(2)} {d(3)} {d(3)} {d(3)}", lambda: f"serial {d(3)}-{d(2)}-{d(4)}",
            lambda: f"code XK{d(2)}{d(4)}{d(4)}{d(4)}", lambda: f"password: required", lambda: f"tokens = {d(3)}", lambda: f"token: {w()}", lambda: f"sha256 {hex_(64)}", lambda: f"commit {hex_(40)}", lambda: f"{w()}-{w()}-{w()}-{w()}-{d(2)}", lambda: f"Mr. {n()}",
            lambda: f"chapter {d(2)} {n()} Road", lambda: f"{d(2)} {d(2)} {d(2)} {d(2)}", lambda: f"{w()}/{w()}/{w()}/{w()}/{d(3)}", lambda: f"born {y()}-{mo()}-{da()} in", lambda: f"{st('on', 'signed', 'call')} {da()}.{mo()}.{y()}", lambda: f"{y()}-{mo()}-{da()} {da()} {mo()}",
            lambda: f"{w()} {st('ab', 'add', 'face')}::{st('cd', 'bad', 'f')} {w()}", lambda: f"look at the dot product of", lambda: f"{w()} at {w()} dot {w()} {w()}", lambda: f"passport office, {w()} {w()} {w()} {w()} {w()} {w()} {d(7)}", lambda: f"passport order {d(8)}",
            lambda: f"{w()}_{w()}_{w()}_{w()}{d(1)}", lambda: f"id run-{hex_(20)}", lambda: f"{w()} {w()}-{d(4)}-{d(2)}-{d(2)}-{w()}",
        ),
        "calibrate": (
            lambda: f"build {d(3)}.{d(3)}.{d(4)}", lambda: f"invoice {d(3)} {d(3)} {d(4)}", lambda: f"page {d(2)}.{d(4)}.20{d(2)}", lambda: f"item no {d(3)} {d(3)} {d(3)}", lambda: f"part {d(3)}-{d(2)}-{d(4)}", lambda: f"serial QZ{d(2)}{d(4)}{d(4)}{d(4)}",
            lambda: f"secret: {w()} {w()}", lambda: f"auth = {w()}", lambda: f"pass: {d(2)}", lambda: f"md5 {hex_(32)}", lambda: f"revision {hex_(40)}", lambda: f"{w()}_{w()}_{w()}_{w()}_{w()}{d(1)}", lambda: f"Dr. {n()}", lambda: f"section {d(3)} {n()} Street", lambda: f"{w()} {d(3)} {d(2)} {d(4)} {d(2)}",
            lambda: f"died {y()}-{mo()}-{da()} at", lambda: f"{st('since', 'account')} {da()} {mo()} {y()}", lambda: f"updated {mo()}-{da()}-{y()}", lambda: f"{st('fade', 'be')}::{st('a', 'dec')}", lambda: f"point at a dot {w()} {w()}", lambda: f"at {w()} at {w()} dot {w()}",
            lambda: f"passport queue of {w()} {w()} {w()} {w()} {w()} {w()} {d(6)}", lambda: f"passport invoice {d(7)}", lambda: f"build job-{hex_(18)}", lambda: f"{w()} {w()}-{w()}-{w()}-{w()}-{d(3)}",
        ),
        "test": (
            lambda: f"revision {d(2)}.{d(3)}.{d(4)}", lambda: f"batch {d(3)} {d(3)} {d(4)}", lambda: f"model {d(3)}-{d(2)}-{d(4)}", lambda: f"credentials: {w()}", lambda: f"checksum {hex_(40)}", lambda: f"digest {hex_(64)}", lambda: f"Prof. {n()}", lambda: f"part {d(2)} {n()} Lane", lambda: f"api_key: none",
            lambda: f"married {y()}.{mo()}.{da()} in", lambda: f"from {da()}-{mo()}-{y()} on", lambda: f"{st('dead', 'ace')}::{st('beef', 'c')}", lambda: f"{w()} at one dot {w()}", lambda: f"passport serial {d(8)}", lambda: f"page {w()}-{w()}-{w()}-{w()}{d(1)}",
        ),
    }
    return [(part, kind, f) for part, kinds in good.items() for kind, fs in kinds.items() for f in fs] + [(part, "", f) for part, fs in bad.items() for f in fs]


def seed_rows(each: int = 60, seed: int = 7) -> list[tuple[int, str, str, str]]:
    """``(id, text, kind, set)``: ``each`` snippets of every template."""
    rng = random.Random(seed)
    templates = seed_templates(rng)
    word = lambda: "".join(rng.choice("aeiorstnl") for _ in range(rng.randint(3, 8)))
    return [(i * each + j, f"{word()} {make()} {word()}", kind, part) for i, (part, kind, make) in enumerate(templates) for j in range(each)]


def boost(counts: dict[tuple[int, int], int], rounds: int = 60, rate: float = 0.3, l2: float = 1.0) -> list[tuple[int, int, list[float]]]:
    """Depth-two gradient-boosted trees for the logistic loss over ``(pattern, label) -> rows``.

    A tree is ``(first feature, second feature, four leaf values)``; leaf ``2 * first + second``.
    """
    cells = np.array(sorted({p for p, _ in counts}), np.int64)
    pos, neg = (np.array([counts.get((int(p), y), 0) for p in cells], float) for y in (1, 0))
    bits = cells[None, :] >> np.arange(len(FEATURES))[:, None] & 1
    pairs = [(i, j) for i in range(len(FEATURES)) for j in range(i + 1, len(FEATURES))]
    leaf = np.array([4 * k + 2 * bits[i] + bits[j] for k, (i, j) in enumerate(pairs)])
    score, trees = np.zeros(len(cells)), []
    for _ in range(rounds if len(cells) else 0):
        q = 1 / (1 + np.exp(-score))
        grad, hess = pos * (1 - q) - neg * q, (pos + neg) * q * (1 - q)
        g, h = (np.bincount(leaf.ravel(), np.tile(x, len(pairs)), 4 * len(pairs)).reshape(-1, 4) for x in (grad, hess))
        best = int(np.argmax((g * g / (h + l2)).sum(1)))
        leaves = rate * g[best] / (h[best] + l2)
        trees.append((*pairs[best], leaves.tolist()))
        score += leaves[leaf[best] - 4 * best]
    return trees


def tree_score(trees: list, pattern: int) -> float:
    return sum(leaves[2 * (pattern >> i & 1) + (pattern >> j & 1)] for i, j, leaves in trees)


def calibrate(trees: list, held: list[tuple[str, int, int, int]], precision: float = 0.97) -> dict[str, float]:
    """Per kind, the lowest score above which held-out rows are personal data in at least ``precision`` of cases.

    The threshold lies half way to the next lower score, where there is none at even odds or the lowest score seen.
    """
    out = {}
    for kind in LOOSE:
        rows = sorted(((tree_score(trees, p), label, n) for k, p, label, n in held if k == kind), reverse=True)
        best, hits, seen = math.inf, 0, 0
        for at, (score, label, n) in enumerate(rows):
            hits, seen = hits + n * label, seen + n
            if (at + 1 == len(rows) or rows[at + 1][0] < score) and hits >= precision * seen:
                best = (score + rows[at + 1][0]) / 2 if at + 1 < len(rows) else min(score, 0.0)
        out[kind] = best
    return out


def curves(trees: list, held: list[tuple[str, int, int, int]], l2: float = 1.0) -> dict[str, tuple[float, float]]:
    """Per kind, ``(a, b)`` such that ``1 / (1 + exp(-a * score - b))`` is the chance that a candidate is what it is reported as.

    Newton steps on the held-out rows; a penalty of ``l2`` holds kinds of few or one-sided rows near the trees' own odds (1, 0).
    """
    out = {}
    for kind in LOOSE:
        rows = [(tree_score(trees, p), label, n) for k, p, label, n in held if k == kind]
        x, label, n = (np.array(v, float) for v in zip(*rows, strict=True)) if rows else (np.empty(0),) * 3
        ab, x = np.array([1.0, 0.0]), np.stack([x, np.ones(len(x))])
        for _ in range(25):
            q = 1 / (1 + np.exp(-np.clip(ab @ x, -30, 30)))
            grad = x @ (n * (q - label)) + l2 * (ab - [1, 0])
            ab = ab - np.clip(np.linalg.solve((x * n * q * (1 - q)) @ x.T + l2 * np.eye(2), grad), -1, 1)
        out[kind] = (float(max(ab[0], 1e-3)), float(ab[1]))
    return out


def reported() -> Column:
    """The kind under which a match is reported."""
    out = F.col("kind")
    for kind, to in REPORTED.items():
        out = F.when(F.col("kind") == kind, to).otherwise(out)
    return out


def seed_patterns(spark: SparkSession) -> dict[str, list[tuple[str, int, int, int]]]:
    """``(kind, pattern, label, rows)`` of the candidates in the seed rows, by set; label 1: the snippet is of the kind that they are reported as."""
    rows = spark.createDataFrame(seed_rows(), "doc_id long, text string, wanted string, part string")
    seen = candidates(rows).where(F.col("kind").isin(*LOOSE)).select("doc_id", "kind", feature_bits().alias("bits")).join(rows.select("doc_id", "wanted", "part"), "doc_id")
    seen = seen.withColumn("label", (reported() == F.col("wanted")).cast("int"))
    out: dict[str, list] = {"fit": [], "calibrate": [], "test": []}
    for r in seen.groupBy("part", "kind", "bits", "label").count().collect():
        out[r["part"]].append((r["kind"], r["bits"], r["label"], r["count"]))
    return out


def fit(spark: SparkSession) -> tuple[list, dict[str, float], dict[str, tuple[float, float]]]:
    """Trees from the templates of one set, thresholds and curves from those of another."""
    seen = seed_patterns(spark)
    counts: dict[tuple[int, int], int] = {}
    for _, bits, label, n in seen["fit"]:
        counts[bits, label] = counts.get((bits, label), 0) + n
    trees = boost(counts)
    return trees, calibrate(trees, seen["calibrate"]), curves(trees, seen["calibrate"])


def score_of(trees: list, bits: Column) -> Column:
    """The trees' sum for a feature pattern."""
    bit = lambda b, i: F.when(b.bitwiseAND(i) != 0, 1).otherwise(0)
    forest = F.array(*(F.struct(F.lit(1 << i).cast("long").alias("i"), F.lit(1 << j).cast("long").alias("j"), F.array(*map(F.lit, v)).alias("v")) for i, j, v in trees))
    step = lambda b: lambda a, t: a + F.get(t["v"], (2 * bit(b, t["i"]) + bit(b, t["j"])).cast("int"))
    # one-element transform: the pattern is worked out once for a row, not once for each tree
    return F.get(F.transform(F.array(bits), lambda b: F.aggregate(forest, F.lit(0.0), step(b))), 0)


def accepted(thresholds: dict[str, float]) -> Column:
    """Whether a loose candidate's ``score`` reaches its kind's threshold."""
    least = F.lit(None).cast("double")
    for kind, at in thresholds.items():
        if at < math.inf:
            least = F.when(F.col("kind") == kind, at - 1e-9).otherwise(least)
    return F.coalesce(F.col("score") >= least, F.lit(False))


def chance(by_kind: dict[str, tuple[float, float]]) -> Column:
    """The calibrated probability of a loose candidate with ``score``, so that candidates of different kinds compare."""
    out = F.lit(None).cast("double")
    for kind, (a, b) in by_kind.items():
        out = F.when(F.col("kind") == kind, 1 / (1 + F.exp(-(a * F.col("score") + b)))).otherwise(out)
    return out


def find(docs: DataFrame) -> DataFrame:
    """Spans of personal data and secrets in every whole text.

    Returns, one row for each input row, ``doc_id``, ``digest`` (of the text), ``n_email, n_ip, n_card, n_phone,
    base_sha256, spans, n_spans`` and ``found``: an array of ``(rank, start, end, kind, base, past)`` in code points, end
    exclusive; ``past`` is where the spans before it end. Base spans always stay. Loose candidates of all generators
    overlap; those whose boosted-tree score reaches the calibrated threshold of their kind and that overlap no base
    span are taken by falling calibrated probability (then the longer, then the earlier), each if it overlaps none taken before;
    one inside another of its kind (a line of a key block) is left to that.

    Null or empty text has no spans (``base_sha256`` is that of the empty string); null ids and repeated rows stay;
    an empty table gives no rows; other columns are not read. One narrow pass finds the matches; only they and one
    row for each document are shuffled. Running sums and maxima over a text's matches replace comparisons of pairs;
    only chains of overlapping candidates are compared among themselves.
    """
    trees, thresholds, by_kind = fit(docs.sparkSession)
    c = candidates(docs)
    by = Window.partitionBy("row", "kind").orderBy("nth")
    loose = F.col("kind").isin(*LOOSE)
    c = c.withColumn("base", F.when(F.col("kind").isin(*BASE), is_base())).withColumn("length", F.char_length("hit"))
    c = c.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("length")).over(by)).withColumn("start", F.col("end") - F.col("length"))
    c = c.withColumn("score", F.when(loose, score_of(trees, feature_bits())))
    c = c.where(F.col("kind").isNull() | F.col("base") | (loose & accepted(thresholds)))
    c = c.withColumn("score", chance(by_kind)).withColumn("kind", reported())
    rank = F.lit(None).cast("int")
    for kind, at in ORDER.items():
        rank = F.when(F.col("kind") == kind, at).otherwise(rank)
    c = c.withColumn("base", F.coalesce("base", F.lit(False))).withColumn("rank", rank)
    here = Window.partitionBy("row").orderBy("start", F.desc("end"), "rank", F.desc("score"))
    back = Window.partitionBy("row").orderBy(F.desc("start"), "end", F.desc("rank"), "score")  # the same order from its end: frames that grow at one side are one pass
    past, come = here.rowsBetween(Window.unboundedPreceding, 0), back.rowsBetween(Window.unboundedPreceding, 0)
    c = c.withColumn("under", F.max(F.when(F.col("base"), F.col("end"))).over(past)).withColumn("next", F.min(F.when(F.col("base"), F.col("start"))).over(come))
    off_base = (F.coalesce("under", F.lit(0)) <= F.col("start")) & (F.coalesce("next", F.col("end")) >= F.col("end"))
    c = c.where(F.col("kind").isNull() | F.col("base") | off_base)
    longest = F.max("end").over(Window.partitionBy("row", "kind", "base").orderBy("start", F.desc("end"), F.desc("score")).rowsBetween(Window.unboundedPreceding, -1))
    c = c.withColumn("longest", longest).where(F.col("kind").isNull() | F.col("base") | (F.coalesce("longest", F.lit(0)) < F.col("end")))
    # a chain is a run of added candidates that overlap; base spans and the document's own row are chains of one
    before = F.max(F.when(~F.col("base"), F.col("end"))).over(here.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.col("base") | F.col("kind").isNull() | (F.coalesce(before, F.lit(0)) <= F.col("start"))
    c = c.withColumn("chain", F.when(F.col("base") | F.col("kind").isNull(), -F.row_number().over(here)).otherwise(F.sum(F.when(fresh, 1).otherwise(0)).over(past)))
    span = F.struct((-F.col("score")).alias("by_score"), (F.col("start") - F.col("end")).alias("by_length"), "start", "end", "rank", "kind", "base")
    clear = lambda a, s: F.when(F.exists(a, lambda t: (t["start"] < s["end"]) & (s["start"] < t["end"])), a).otherwise(F.concat(a, F.array(s)))
    c = c.groupBy("row", "doc_id", "digest", "chain").agg(F.array_sort(F.collect_list(span)).alias("all"))
    c = c.select("row", "doc_id", "digest", F.explode(F.when(F.size("all") > 1, F.aggregate("all", F.slice("all", 1, 0), clear)).otherwise(F.col("all"))).alias("s")).select("row", "doc_id", "digest", "s.*")
    c = c.withColumn("past", F.coalesce(F.max("end").over(Window.partitionBy("row").orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    span = F.when(F.col("kind").isNotNull(), F.struct("rank", "start", "end", "kind", "base", "past"))
    count = lambda k: F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}")
    text = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return (
        c.groupBy("row", "doc_id", "digest")
        .agg(*map(count, BASE), F.array_sort(F.collect_list(span)).alias("found"))
        .select("doc_id", "digest", *(f"n_{k}" for k in BASE), F.sha2(text(F.filter("found", lambda s: s["base"])), 256).alias("base_sha256"), text(F.col("found")).alias("spans"), F.size("found").cast("long").alias("n_spans"), "found")
    )


def by_block(found: DataFrame, i: str, digest: str, name: str) -> DataFrame:
    """``name``: for each text, once for each id and digest, the spans that reach into its first, second, ... block of code points."""
    one = found.select(F.coalesce("doc_id", F.lit(0)).alias(i), F.col("digest").alias(digest), "found").dropDuplicates([i, digest])
    at = lambda c: (F.floor(c / BLOCK)).cast("int")
    every = one.select(i, digest, F.explode(F.sequence(F.lit(0), at(F.array_max(F.transform("found", lambda s: s["end"])) - 1))).alias("b"), F.lit(None).alias("s"))
    held = one.select(i, digest, F.explode("found").alias("s")).select(
        i, digest, F.explode(F.sequence(at(F.col("s.start")), at(F.col("s.end") - 1))).alias("b"), F.struct("s.start", "s.end", "s.kind", "s.past").alias("s")
    )
    lists = held.unionByName(every).groupBy(i, digest, "b").agg(F.array_sort(F.collect_list("s")).alias("l"))  # at most as many as a block has code points, for each kind
    return lists.groupBy(i, digest).agg(F.transform(F.array_sort(F.collect_list(F.struct("b", "l"))), lambda x: x["l"]).alias(name))


def redacted_block(text: Column, n: Column, spans: Column) -> Column:
    """Block ``n`` of a text with the labels of the spans that begin in it, without what any span covers."""
    low = n.cast("long") * BLOCK
    here = lambda p: F.greatest(p - low, F.lit(0)).cast("int")
    label = lambda s: F.concat(F.substring(text, here(s["past"]) + 1, (s["start"] - low).cast("int") - here(s["past"])), F.lit("["), F.upper(s["kind"]), F.lit("]"))
    piece = lambda s: F.when((s["start"] < s["past"]) | (s["start"] < low), "").otherwise(label(s))
    rest = F.substring(text, here(F.array_max(F.transform(spans, lambda s: s["end"]))) + 1, F.lit(BLOCK))
    return F.when(F.coalesce(F.size(spans), F.lit(0)) > 0, F.concat(F.array_join(F.transform(spans, piece), ""), rest)).otherwise(text)


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by ``[KIND]``, overlapping spans by that of the first; ``n_chars`` follows.

    Columns and rows stay as they are, and so does a text without spans, null ones included; an empty table gives none.
    Spans come back by id and text digest, once for each, so the join neither depends on row order nor multiplies
    repeated rows. A text is cut into blocks in one pass and a span looks at its own blocks only, so work grows with text and
    spans, not with their product. A bitmap of fixed size (a table of at most ``BITS / 64`` rows, so broadcast) tells which rows can
    have spans: only those are shuffled.
    """
    cols, tag = docs.columns, "_" * (1 + max(map(len, docs.columns)))  # no column has a name that long
    i, digest, at, marks, spans_ = (f"{x}{tag}" for x in "idams")
    key = lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(BITS))
    bit = lambda h: F.pmod(h, F.lit(64)).cast("int")
    spans = checkpoint(by_block(find(docs).where(F.size("found") > 0), i, digest, spans_))
    hashed = spans.select(key(F.col(i), F.col(digest)).alias("h"))
    there = hashed.groupBy(F.shiftright("h", 6).alias(at)).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit(F.col("h")))).alias(marks))
    marked = docs.withColumns({i: F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), digest: F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))})
    marked = marked.withColumn(at, F.shiftright(key(F.col(i), F.col(digest)), 6)).join(F.broadcast(there), at, "left")
    can = F.coalesce(F.call_function("shiftright", F.col(marks), bit(key(F.col(i), F.col(digest)))).bitwiseAND(1) == 1, F.lit(False))
    joined = marked.where(can).join(spans, [i, digest], "left")
    blocks = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    replaced = F.array_join(F.transform(blocks, lambda t, n: redacted_block(t, n, F.get(F.col(spans_), n))), "")
    joined = joined.withColumn("text", F.when(F.col(spans_).isNull(), F.col("text")).otherwise(replaced))
    if "n_chars" in cols:
        joined = joined.withColumn("n_chars", F.when(F.col(spans_).isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long")))
    return marked.where(~can).select(cols).unionByName(joined.select(cols))
