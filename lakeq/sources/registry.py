"""The delimited sources of the lakehouse: columns in order, with the type each is read as."""

from __future__ import annotations

from dataclasses import dataclass
from fnmatch import fnmatch


@dataclass(frozen=True)
class Source:
    """Files of one source: glob, delimiter, batches, columns as (name, type)."""

    name: str
    glob: str
    delimiter: str
    batches: tuple[int, ...]
    columns: tuple[tuple[str, str], ...]
    control: bool = False

    @property
    def names(self) -> list[str]:
        return [n for n, _ in self.columns]


def _columns(text: str) -> tuple[tuple[str, str], ...]:
    """``a b:integer``: a string column and an integer column."""
    return tuple((n, k or "string") for n, _, k in (c.partition(":") for c in text.split()))


# The layouts of the source files.
_ALL = (1, 2, 3)
SOURCES = {
    s.name: s
    for s in (
        Source("status_type", "StatusType.txt", "|", (1,), _columns("st_id st_name")),
        Source("trade_type", "TradeType.txt", "|", (1,), _columns("tt_id tt_name tt_is_sell:integer tt_is_mrkt:integer")),
        Source("tax_rate", "TaxRate.txt", "|", (1,), _columns("tx_id tx_name tx_rate:number")),
        Source("industry", "Industry.txt", "|", (1,), _columns("in_id in_name in_sector")),
        Source("date", "Date.txt", "|", (1,), _columns("sk_date:integer date_value:date date_desc year:integer month_num:integer month_of_year:integer quarter_name quarter:integer month_name month_of_year_2:integer week_of_year:integer day_of_week_num:integer day_of_week_name fiscal_year:integer fiscal_quarter:integer fiscal_year_quarter fiscal_period holiday_flag:boolean")),
        Source("time", "Time.txt", "|", (1,), _columns("sk_time:integer time_value hour:integer minute:integer second:integer hh_mm minute_of_day:integer hh_mm_ss is_work_hour:boolean is_night_hour:boolean")),
        Source("hr", "HR.csv", ",", (1,), _columns("employee_id:integer manager_id:integer employee_last_name employee_first_name employee_mi employee_job_code:integer employee_branch employee_office employee_phone")),
        Source("prospect", "Prospect.csv", ",", _ALL, _columns("agency_id last_name first_name middle_initial gender address_line1 address_line2 postal_code city state_province country phone income:integer number_cars:integer number_children:integer marital_status age:integer credit_rating:integer own_or_rent_flag employer number_credit_cards:integer net_worth:integer")),
        Source("customer_update", "Customer.txt", "|", (2, 3), _columns("action_type customer_id:integer tax_id national_tax_id status last_name first_name middle_initial gender tier dob address_line1 address_line2 postal_code city state_province country phone1 phone2 phone3 local_tax_id_1 local_tax_id_2 local_tax_id_3 local_tax_id_4 email1 email2 local_tax_id_5 local_tax_id_6 local_tax_id_7 local_tax_id_8 local_tax_id_9 local_tax_id_10 local_tax_id_11")),
        Source("account_update", "Account.txt", "|", (2, 3), _columns("action_type account_id:integer customer_id:integer broker_id:integer account_name account_tax_status account_desc account_status")),
        Source("daily_market", "DailyMarket.txt", "|", _ALL, _columns("dm_date:date dm_s_symb dm_close:number dm_high:number dm_low:number dm_volume:integer")),
        Source("trade", "Trade.txt", "|", _ALL, _columns("trade_id:integer trade_dts status ttype is_cash:integer s_symbol trade_quantity:integer trade_price:number execution_id:integer execution_broker_id:integer cash_amount:number fee:number commission:number tax:number")),
        Source("trade_history", "TradeHistory.txt", "|", (1,), _columns("th_trade_id:integer th_dts th_status")),
        Source("cash_transaction", "CashTransaction.txt", "|", _ALL, _columns("ct_ca_id:integer ct_dts ct_amt:number ct_name")),
        Source("holding_history", "HoldingHistory.txt", "|", _ALL, _columns("hh_h_t_id:integer hh_t_id:integer hh_before_qty:integer hh_after_qty:integer")),
        Source("watch_history", "WatchHistory.txt", "|", _ALL, _columns("wh_c_id:integer wh_s_symb wh_dts wh_action")),
        Source("batch_date", "BatchDate.txt", "|", _ALL, _columns("batch_date:date"), control=True),
    )
}


def sources_of_batch(batch: int, include_control: bool = False) -> list[str]:
    return [s.name for s in SOURCES.values() if batch in s.batches and (include_control or not s.control)]


def resolve_files(names: list[str], source: str, exclude: tuple[str, ...] = ("*_audit.csv",)) -> list[str]:
    """The files of a source among ``names``, sorted, without excluded ones."""
    glob = SOURCES[source].glob
    return sorted(n for n in names if fnmatch(n.rsplit("/", 1)[-1], glob) and not any(fnmatch(n, e) for e in exclude))
