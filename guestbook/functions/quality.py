"""Email and phone rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from guestbook.functions._columns import ColumnOrName, as_col
from guestbook.functions.text import digits

VALID = "valid"
INVALID = "invalid"

# Fixed values of the email rule. A word character is any letter or digit, not only ASCII ones, which is
# all that \w stands for here. [^\n] is "any character but \n"; the dot would leave out other line ends too.
EMAIL_SHAPE = r"[\p{L}\p{N}_.-]+@[\p{L}\p{N}_.-]+[^\n][\p{L}\p{N}_]+"
EMAIL_SHAPE_SEVEN = r"[\p{L}\p{N}_.]+@[\p{L}\p{N}_.]"
TOP_LEVEL = ["com", "org", "net", "int", "edu", "gov", "mil", "biz"]
TOP_LEVEL_SEVEN = ["com", "org", "net", "int", "edu", "gov", "mil"]
LOCAL_BANNED = ["www", "http"]

# Fixed values of the phone rule: fewest and most digits.
PHONE_DIGITS = (10, 12)

# Fixed values of the permissive syntax check.
LOCAL_MAX, DOMAIN_MAX, ADDRESS_MAX, LABEL_MAX = 64, 253, 254, 63
LOCAL_CHARS = r"^[A-Za-z0-9!#$%&'*+\-/=?^_`{|}~.]+$"
DOMAIN_CHARS = r"^[A-Za-z0-9.\-]+$"
RESERVED_TOP_LEVEL = ["arpa", "invalid", "local", "localhost", "onion", "test"]


def _flag(ok: Column) -> Column:
    return F.when(F.coalesce(ok, F.lit(False)), VALID).otherwise(INVALID)


def _count_at(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("@"), F.lit("")))


def email_ok(c: ColumnOrName) -> Column:
    """True, false, or null when the address is null."""
    text = F.lower(as_col(c))
    local = F.substring_index(text, "@", 1)
    domain = F.substring_index(text, "@", -1)
    ok = (
        text.rlike(EMAIL_SHAPE)
        & (_count_at(text) <= 1)
        & domain.contains(".")
        & F.substring_index(domain, ".", -1).isin(TOP_LEVEL)
    )
    for word in LOCAL_BANNED:
        ok = ok & ~local.contains(word)
    return ok


def email_status(c: ColumnOrName) -> Column:
    """``valid`` or ``invalid``; null is invalid."""
    return _flag(email_ok(c))


def email_status_seven(c: ColumnOrName) -> Column:
    """Older rule: seven domains, last dot of the whole text, case as given."""
    text = as_col(c)
    return _flag(text.rlike(EMAIL_SHAPE_SEVEN) & F.substring_index(text, ".", -1).isin(TOP_LEVEL_SEVEN))


def phone_ok(c: ColumnOrName) -> Column:
    return F.length(digits(c)).between(*PHONE_DIGITS)


def phone_status(c: ColumnOrName) -> Column:
    """``valid`` when 10 to 12 digits remain; null is invalid."""
    return _flag(phone_ok(c))


def any_phone_status(*cols: ColumnOrName) -> Column:
    """``valid`` when any of the columns holds a valid number."""
    ok = F.lit(False)
    for c in cols:
        ok = ok | F.coalesce(phone_ok(c), F.lit(False))
    return _flag(ok)


def email_reason(c: ColumnOrName) -> Column:
    """Permissive syntax check: ``valid email``, or the first rule the address breaks."""
    text = as_col(c)
    local = F.substring_index(text, "@", 1)
    domain = F.substring_index(text, "@", -1)
    last_label = F.lower(F.substring_index(domain, ".", -1))
    return (
        F.when(text.isNull(), "missing")
        .when(_count_at(text) == 0, "no @-sign")
        .when(_count_at(text) > 1, "more than one @-sign")
        .when(local == "", "nothing before the @-sign")
        .when(domain == "", "nothing after the @-sign")
        .when(F.length(text) > ADDRESS_MAX, "address too long")
        .when(F.length(local) > LOCAL_MAX, "too long before the @-sign")
        .when(F.length(domain) > DOMAIN_MAX, "too long after the @-sign")
        .when(~local.rlike(LOCAL_CHARS), "bad character before the @-sign")
        .when(local.startswith(".") | local.endswith(".") | local.contains(".."), "misplaced period before the @-sign")
        .when(~domain.rlike(DOMAIN_CHARS), "bad character after the @-sign")
        .when(domain.startswith(".") | domain.endswith(".") | domain.contains(".."), "misplaced period after the @-sign")
        .when(domain.rlike(r"(^|\.)-|-($|\.)"), "misplaced hyphen after the @-sign")
        .when(domain.rlike(r"[^.]{%d,}" % (LABEL_MAX + 1)), "domain label too long")
        .when(~domain.contains("."), "no period after the @-sign")
        .when(~last_label.rlike("[a-z]$"), "domain does not end in a letter")
        .when(last_label.isin(RESERVED_TOP_LEVEL), "reserved domain")
        .otherwise("valid email")
    )
