"""Text normalisation as column expressions."""

from __future__ import annotations

import string
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# the Python helpers travel with the job, executors need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# fixed values: patterns and the placeholder the normalised texts must agree with
URL_PATTERN = (
    r"https?:\/\/(www\.)?([-a-zA-Z0-9@:%._\+~#=]{1,256}\.[a-zA-Z0-9()]{1,6})"
    r"\b([-a-zA-Z0-9()@:%_\+.~#?&\/\/=]*)"
)
TOKEN_LETTERS = "ёЁа-яА-Яa-zA-Z0-9-"  # kept by the token form, everything else is blanked
RUN_CHARACTERS = " \\n;"
MISSING_TEXT = "!пусто!"

# Unicode white space plus the four separators a Python strip() also removes
_SPACE = r"(?U)[\s\x1c-\x1f]"


def reduce_urls(text: Column) -> Column:
    """Every http(s) URL becomes its host, without 'www.' and path."""
    return F.regexp_replace(text, F.lit("(?U)" + URL_PATTERN), F.lit("$2"))


def collapse_runs(text: Column) -> Column:
    """A run of blanks, newlines and ';' becomes its last character."""
    # a single character stays as it is, so only longer runs are matched
    return F.regexp_replace(text, F.lit(f"[{RUN_CHARACTERS}]+([{RUN_CHARACTERS}])"), F.lit("$1"))


def strip(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, f"^{_SPACE}+", ""), f"{_SPACE}+$", "")


def normalise_tokens(text: Column) -> Column:
    """Lower case, URLs reduced, everything but letters, digits and '-' blanked, single blanks."""
    # the runs kept are taken out and joined: replacing all others takes eight times as long in Java. ASCII is spelled out
    # because single characters are tested in a bit set but ranges one by one, and the text is in lower case here
    kept = string.ascii_lowercase + string.digits + "а-яё-"
    return F.array_join(F.regexp_extract_all(reduce_urls(F.lower(text)), F.lit(f"[{kept}]+"), F.lit(0)), " ")


def normalise_prose(text: Column) -> Column:
    """Lower case, URLs reduced, white space unified; punctuation stays. Null becomes a placeholder."""
    plain = F.translate(reduce_urls(F.lower(text)), "\t‚", " ,")
    lines = F.translate(F.replace(plain, F.lit("\r\n"), F.lit("\n")), "\r", "\n")
    return F.coalesce(strip(collapse_runs(lines)), F.lit(MISSING_TEXT))


@F.pandas_udf(T.StringType())
def _decode_idna(hosts: pd.Series) -> pd.Series:
    return hosts.map(_idna_or_same, na_action="ignore")


def _idna_or_same(host: str) -> str:
    try:
        return host.encode().decode("idna")
    except UnicodeError:
        return host


def depunycode(host: Column) -> Column:
    """Decode hosts that start with 'xn--'; anything undecodable stays as it is."""
    # the UDF sees null for all other hosts, so only punycode hosts cost Python work
    encoded = F.when(host.startswith("xn--"), host)
    return F.coalesce(_decode_idna(encoded), host)


def compose_text(host: Column, title: Column, description: Column, body: Column, separator: str,
                 max_tokens: int = 512) -> Column:
    """``host SEP title SEP description SEP text``, cut to ``max_tokens`` blank-separated tokens."""
    text = F.when(body.isNull(), F.lit("")).otherwise(normalise_prose(body))
    full = F.concat_ws(f" {separator} ", host, normalise_prose(title), normalise_prose(description), text)
    return F.substring_index(full, " ", max_tokens)
