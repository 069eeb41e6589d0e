"""Table schemas and fixed conventions of the warehouse.

Fixed values (must equal the reference for identical results):
  open end of a version ............ 2999-01-01
  initial watermark ................ 1900-01-01
  staging labels of rule 4 ......... REJECT, SUCCESS
  rule 3 gap ....................... less than 1 hour
  rule 4 span ...................... at most 20 minutes, 3 rejects then a success
  file name day .................... _DDMMYYYY before the extension
  file kinds ....................... passport_blacklist, terminals, transactions
  event types ...................... 1 passport, 2 contract, 3 city hop, 4 amount probe
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import types as T

REFERENCE = "reference"
STRICT = "strict"
SEMANTICS = (REFERENCE, STRICT)

OPEN_END = _dt.date(2999, 1, 1)
INITIAL_WATERMARK = _dt.date(1900, 1, 1)

REJECT = "REJECT"
SUCCESS = "SUCCESS"
CITY_HOP_GAP = "1 hour"
PROBE_SPAN = "20 minutes"
PROBE_REJECTS = 3

EVENT_PASSPORT = 1
EVENT_CONTRACT = 2
EVENT_CITY_HOP = 3
EVENT_AMOUNT_PROBE = 4

KIND_BLACKLIST = "passport_blacklist"
KIND_TERMINALS = "terminals"
KIND_TRANSACTIONS = "transactions"
FILE_KINDS = (KIND_BLACKLIST, KIND_TERMINALS, KIND_TRANSACTIONS)

# --- input files ------------------------------------------------------------

# transactions_DDMMYYYY.txt: ';'-separated, header, decimal comma in amount.
TRANSACTIONS_FILE = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("transaction_date", T.StringType()),
    T.StructField("amount", T.StringType()),
    T.StructField("card_num", T.StringType()),
    T.StructField("oper_type", T.StringType()),
    T.StructField("oper_result", T.StringType()),
    T.StructField("terminal", T.StringType()),
])

TERMINALS_FILE = T.StructType([
    T.StructField("terminal_id", T.StringType()),
    T.StructField("terminal_type", T.StringType()),
    T.StructField("terminal_city", T.StringType()),
    T.StructField("terminal_address", T.StringType()),
])

BLACKLIST_FILE = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("passport", T.StringType()),
])

# --- warehouse tables -------------------------------------------------------

FACT_TRANSACTIONS = T.StructType([
    T.StructField("trans_id", T.StringType()),
    T.StructField("trans_date", T.TimestampNTZType()),
    T.StructField("amt", T.DecimalType(30, 2)),
    T.StructField("card_num", T.StringType()),
    T.StructField("oper_type", T.StringType()),
    T.StructField("oper_result", T.StringType()),
    T.StructField("terminal", T.StringType()),
    T.StructField("trans_day", T.DateType()),
])

BLACKLIST = T.StructType([
    T.StructField("passport_num", T.StringType()),
    T.StructField("entry_dt", T.DateType()),
])

_VERSION = [
    T.StructField("effective_from", T.DateType()),
    T.StructField("effective_to", T.DateType()),
    T.StructField("deleted_flg", T.BooleanType()),
]

TERMINALS_HIST = T.StructType([
    T.StructField("terminal_id", T.StringType()),
    T.StructField("terminal_type", T.StringType()),
    T.StructField("terminal_city", T.StringType()),
    T.StructField("terminal_address", T.StringType()),
    *_VERSION,
])

CARDS_HIST = T.StructType([
    T.StructField("card_num", T.StringType()),
    T.StructField("account_num", T.StringType()),
    *_VERSION,
])

ACCOUNTS_HIST = T.StructType([
    T.StructField("account_num", T.StringType()),
    T.StructField("valid_to", T.DateType()),
    T.StructField("client", T.StringType()),
    *_VERSION,
])

CLIENTS_HIST = T.StructType([
    T.StructField("client_id", T.StringType()),
    T.StructField("fio", T.StringType()),
    T.StructField("date_of_birth", T.DateType()),
    T.StructField("passport_num", T.StringType()),
    T.StructField("passport_valid_to", T.DateType()),
    T.StructField("phone", T.StringType()),
    *_VERSION,
])

REPORT = T.StructType([
    T.StructField("event_dt", T.StringType()),
    T.StructField("passport", T.StringType()),
    T.StructField("fio", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("event_type", T.IntegerType()),
    T.StructField("report_dt", T.DateType()),
    T.StructField("event_ts", T.TimestampNTZType()),
])

# Dimension specs: key, compared attributes, schema.
DIMENSIONS = {
    "terminals": ("terminal_id", ["terminal_type", "terminal_city", "terminal_address"], TERMINALS_HIST),
    "cards": ("card_num", ["account_num"], CARDS_HIST),
    "accounts": ("account_num", ["valid_to", "client"], ACCOUNTS_HIST),
    "clients": ("client_id", ["fio", "date_of_birth", "passport_num", "passport_valid_to", "phone"], CLIENTS_HIST),
}

# The declared maximum text lengths (checked by operators.checks).
MAX_LENGTHS = {
    "terminals": {"terminal_id": 30, "terminal_type": 30, "terminal_city": 30, "terminal_address": 300},
    "cards": {"card_num": 50, "account_num": 50},
    "accounts": {"account_num": 50, "client": 100},
    "clients": {"client_id": 50, "fio": 100, "passport_num": 50, "phone": 50},
    "fact_transactions": {"trans_id": 20, "card_num": 30, "oper_type": 30, "oper_result": 30, "terminal": 30},
    "blacklist": {"passport_num": 50},
    "report": {"passport": 30, "fio": 100, "phone": 16},
}
