"""Small hand-made daily input files for daily-run tests."""

from __future__ import annotations

import datetime as dt
import os

from tallyhawk.sources.excel import write_xlsx

DAYS = [dt.date(2021, 3, 1), dt.date(2021, 3, 2), dt.date(2021, 3, 3)]
OPEN = dt.date(2999, 1, 1)

TERMINALS = {
    0: [("T1", "POS", "Moscow", "Tverskaya 1"), ("T2", "ATM", "SPB", "Nevsky 2"), ("T3", "POS", "Kazan", "Bauman 3")],
    1: [("T1", "POS", "Tver", "Lenina 1"), ("T3", "POS", "Kazan", "Bauman 3"), ("T4", "ATM", "Omsk", "Mira 4")],
    2: [("T1", "POS", "Tver", "Lenina 1"), ("T2", "ATM", "SPB", "Nevsky 2"), ("T3", "POS", "Kazan", "Bauman 3")],
}
BLACKLIST = {0: [(dt.date(2021, 2, 1), "1111 000002")], 1: [(dt.date(2021, 2, 1), "1111 000002")],
             2: [(dt.date(2021, 2, 1), "1111 000002"), (dt.date(2021, 3, 3), "1111 000003")]}


def _amt(x: float) -> str:
    return f"{x:.2f}".replace(".", ",")


def transactions(i: int):
    d = DAYS[i]

    def ts(h, m, s=0):
        return dt.datetime(d.year, d.month, d.day, h, m, s).strftime("%Y-%m-%d %H:%M:%S")
    rows = [
        # card 1 (client 1, passport expired on day 2): one op per day
        (f"{i}01", ts(9, 0), _amt(100.5), "C1", "PAYMENT", "SUCCESS", "T3"),
        # card 2 (client 2, blacklisted passport)
        (f"{i}02", ts(9, 30), _amt(50), "C2", "PAYMENT", "SUCCESS", "T3"),
        # card 3: amount probing, 3 rejects then success within 20 minutes
        (f"{i}03", ts(12, 0), _amt(900), "C3", "WITHDRAW", "REJECT", "T3"),
        (f"{i}04", ts(12, 2), _amt(800), "C3", "WITHDRAW", "REJECT", "T3"),
        (f"{i}05", ts(12, 4), _amt(700), "C3", "WITHDRAW", "REJECT", "T3"),
        (f"{i}06", ts(12, 6), _amt(600), "C3", "WITHDRAW", "SUCCESS", "T3"),
        # card 4: Kazan then terminal 2 or 4 then Kazan within the hour
        (f"{i}07", ts(15, 0), _amt(10), "C4", "PAYMENT", "SUCCESS", "T3"),
        (f"{i}08", ts(15, 20), _amt(10), "C4", "PAYMENT", "SUCCESS", "T2" if i != 1 else "T4"),
        (f"{i}09", ts(15, 40), _amt(10), "C4", "PAYMENT", "SUCCESS", "T3"),
    ]
    return rows


def write_day(input_dir: str, i: int, ext: str = "txt", extra_rows=(), rows=None, terminals=None):
    d = DAYS[i].strftime("%d%m%Y")
    os.makedirs(input_dir, exist_ok=True)
    with open(os.path.join(input_dir, f"transactions_{d}.{ext}"), "w") as f:
        f.write("transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n")
        for r in [*(transactions(i) if rows is None else rows), *extra_rows]:
            f.write(";".join(r) + "\n")
    write_xlsx(os.path.join(input_dir, f"terminals_{d}.xlsx"),
               ["terminal_id", "terminal_type", "terminal_city", "terminal_address"],
               [list(r) for r in terminals or TERMINALS[i]])
    write_xlsx(os.path.join(input_dir, f"passport_blacklist_{d}.xlsx"), ["date", "passport"],
               [list(r) for r in BLACKLIST[i]])


def sources(spark):
    """Relational sources; card C4 moves to account A2 on day 2 (update_dt = day 2)."""
    def for_day(day):
        cards = [("C1", "A1", None), ("C2", "A2", None), ("C3", "A3", None),
                 ("C4", "A4" if day < DAYS[1] else "A2", DAYS[0] if day < DAYS[1] else DAYS[1])]
        accounts = [("A1", dt.date(2030, 1, 1), "K1", DAYS[0]), ("A2", dt.date(2030, 1, 1), "K2", DAYS[0]),
                    ("A3", dt.date(2021, 3, 2), "K3", DAYS[0]), ("A4", dt.date(2030, 1, 1), "K4", DAYS[0])]
        clients = [("K1", "Ivanov", "Ivan", "Ivanovich", dt.date(1980, 1, 1), "1111 000001", dt.date(2021, 3, 2),
                    "+7 900 000 01", DAYS[0]),
                   ("K2", "Petrov", "Petr", "Petrovich", dt.date(1981, 1, 1), "1111 000002", dt.date(2030, 1, 1),
                    "+7 900 000 02", DAYS[0]),
                   ("K3", "Sidorov", "Sidor", None, dt.date(1982, 1, 1), "1111 000003", dt.date(2030, 1, 1),
                    "+7 900 000 03", DAYS[0]),
                   ("K4", "Orlov", "Oleg", "Olegovich", dt.date(1983, 1, 1), "1111 000004", dt.date(2030, 1, 1),
                    "+7 900 000 04", DAYS[0])]
        from tallyhawk.plans.daily import Sources
        return Sources(
            spark.createDataFrame(cards, "card_num string, account string, update_dt date"),
            spark.createDataFrame(accounts, "account string, valid_to date, client string, update_dt date"),
            spark.createDataFrame(clients, "client_id string, last_name string, first_name string, "
                                           "patronymic string, date_of_birth date, passport_num string, "
                                           "passport_valid_to date, phone string, update_dt date"))
    return for_day
