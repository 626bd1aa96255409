from guestbook.functions.keys import natural_key
from guestbook.functions.quality import (
    any_phone_status,
    email_reason,
    email_status,
    email_status_seven,
    phone_status,
)
from guestbook.functions.text import (
    digits,
    phone_text,
    squeeze,
    street_line,
    trim_blank,
    year_text,
)
from guestbook.functions.times import date_path, epoch_micros, from_epoch_micros

__all__ = [
    "any_phone_status",
    "date_path",
    "digits",
    "email_reason",
    "email_status",
    "email_status_seven",
    "epoch_micros",
    "from_epoch_micros",
    "natural_key",
    "phone_status",
    "phone_text",
    "squeeze",
    "street_line",
    "trim_blank",
    "year_text",
]
