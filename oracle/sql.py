"""DuckDB oracle SQL, one statement per registered query.

Written from the definitions of SURVEY section 2.8, independently of the Spark
operators: an explicit state per table and year, each year adding what its batch
has and the state before it lacks (NOT EXISTS), so the oracle checks the Spark
set-based backfills against the year-by-year meaning.

Engine spelling differences (SURVEY section 5): DuckDB rounds where Spark
truncates (avg -> int, text -> int), so truncation is explicit here; year()
is BIGINT in DuckDB and is cast to INTEGER; DECIMAL sums are cast to
DECIMAL(20,2); ORDER BY tie-breaks name their NULL placement.
"""

from __future__ import annotations

from oracle.fixtures import STG

# Payment dates of the fixtures span these years at every scale factor.
YEARS = list(range(1995, 2002))
# LOAD_DATE of the single run that loads the second vault (the run after the last year).
V2_LOAD_DATE = "2002-01-01 00:00:00"
RECORD_SOURCE = "PAYMENT - DATA LAKE"
MDM_RECORD_SOURCE = "MDM - USERS"
RELOAD_YEAR = 1998
LAKE_YEAR, EVENT_YEAR = 1998, 2024
# The year that both of two batches hold, and their LOAD_DATEs.
OVERLAP = 1997
LOADS = [("early", f"{OVERLAP + 1}-01-01 00:00:00", f"<= {OVERLAP}"), ("late", V2_LOAD_DATE, f">= {OVERLAP}")]


class With:
    """Ordered CTE list -> one SQL statement."""

    def __init__(self):
        self.ctes: list[tuple[str, str]] = []
        self.names: set[str] = set()

    def add(self, name: str, body: str) -> "With":
        if name not in self.names:
            self.ctes.append((name, body))
            self.names.add(name)
        return self

    def stg(self, *names: str) -> "With":
        for n in names:
            self.add(n, STG[n])
        return self

    def sql(self, final: str) -> str:
        if not self.ctes:
            return final
        parts = ",\n".join(f"{n} AS (\n{b}\n)" for n, b in self.ctes)
        return f"WITH {parts}\n{final}"


def _int_of_text(c: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST({c} AS DECIMAL(38,10))) AS INTEGER)"


def _norm(c: str) -> str:
    return f"nullif(upper(trim(CAST({c} AS VARCHAR))), '')"


def _hk(*cols: str) -> str:
    if len(cols) == 1:
        return f"md5({_norm(cols[0])})"
    parts = ", ".join(f"coalesce({_norm(c)}, '^^')" for c in cols)
    return f"md5(nullif(concat_ws('||', {parts}), '{'||'.join(['^^'] * len(cols))}'))"


def _hd(*cols: str) -> str:
    parts = ", ".join(f"coalesce({_norm(c)}, '^^')" for c in cols)
    return f"md5(concat_ws('||', {parts}))"


# ------------------------------------------------------------------ ODS

def _typed_payment(w: With) -> str:
    w.stg("stg_payment")
    w.add("typed_payment", """
SELECT user_id, pay_doc_type, pay_doc_num, account, phone,
  TRY_CAST(billing_period || '-01' AS DATE) AS billing_period,
  TRY_CAST(pay_date AS DATE) AS pay_date,
  TRY_CAST(sum AS DECIMAL(10,2)) AS sum
FROM stg_payment""")
    return "typed_payment"


def q01() -> str:
    w = With().stg("stg_billing")
    return w.sql(f"""
SELECT user_id, TRY_CAST(billing_period || '-01' AS DATE) AS billing_period, service, tariff,
  {_int_of_text('sum')} AS sum, TRY_CAST(created_at AS DATE) AS created_at,
  CAST(year(TRY_CAST(created_at AS DATE)) AS VARCHAR) AS year
FROM stg_billing WHERE year(TRY_CAST(created_at AS DATE)) IS NOT NULL""")


def q02() -> str:
    w = With().stg("stg_issue")
    return w.sql(f"""
SELECT {_int_of_text('user_id')} AS user_id,
  TRY_CAST(start_time AS TIMESTAMP) AS start_time, TRY_CAST(end_time AS TIMESTAMP) AS end_time,
  title, description, service, CAST(year(TRY_CAST(start_time AS DATE)) AS VARCHAR) AS year
FROM stg_issue WHERE year(TRY_CAST(start_time AS DATE)) IS NOT NULL""")


def q03() -> str:
    w = With()
    t = _typed_payment(w)
    return w.sql(f"""
SELECT *, CAST(year(pay_date) AS VARCHAR) AS year FROM {t} WHERE pay_date IS NOT NULL""")


def _ods_traffic(w: With) -> str:
    w.stg("stg_traffic")
    w.add("ods_traffic", """
SELECT user_id, epoch_ms("timestamp") AS "timestamp", device_id, device_ip_addr, bytes_sent, bytes_received,
  CAST(year(epoch_ms(CAST(trunc("timestamp" / 1000) AS BIGINT) * 1000)) AS VARCHAR) AS year
FROM stg_traffic WHERE "timestamp" IS NOT NULL""")
    return "ods_traffic"


def q04() -> str:
    w = With()
    t = _ods_traffic(w)
    return w.sql(f"SELECT * FROM {t}")


def q05() -> str:
    w = With()
    t = _ods_traffic(w)
    return w.sql(f"""
SELECT user_id, max(bytes_received) AS max_traffic, min(bytes_received) AS min_traffic,
  CAST(trunc(avg(bytes_received)) AS INTEGER) AS avg_traffic, year
FROM {t} GROUP BY year, user_id""")


def q06() -> str:
    return With().stg("stg_payment_typed").sql("SELECT * FROM stg_payment_typed")


def q07() -> str:
    """Whatever was in ODS for the reloaded year, afterwards all years are the source's."""
    return q06()


# ------------------------------------------------------------------ stage

def _stage(w: With) -> str:
    t = _typed_payment(w)
    w.add("stage", f"""
SELECT user_id, pay_doc_type, pay_doc_num, account, phone, billing_period, pay_date, sum,
  CAST(user_id AS VARCHAR) AS user_key, CAST(account AS VARCHAR) AS account_key,
  CAST(billing_period AS VARCHAR) AS billing_period_key,
  CAST(pay_doc_type AS VARCHAR) AS pay_doc_type_key, CAST(pay_doc_num AS VARCHAR) AS pay_doc_num_key,
  '{RECORD_SOURCE}' AS record_source,
  {_hk('user_id')} AS user_pk, {_hk('account')} AS account_pk,
  {_hk('billing_period')} AS billing_period_pk,
  {_hk('pay_doc_type', 'pay_doc_num')} AS pay_doc_pk,
  {_hk('user_id', 'account', 'billing_period', 'pay_doc_type', 'pay_doc_num')} AS user_account_billing_pay_pk,
  {_hd('phone')} AS user_hashdiff,
  {_hd('pay_date', 'sum')} AS pay_doc_hashdiff,
  make_timestamp(CAST(year(pay_date) AS BIGINT), 1, 1, 0, 0, 0) AS load_date,
  pay_date AS effective_from
FROM {t} WHERE pay_date IS NOT NULL""")
    return "stage"


def q08() -> str:
    w = With()
    s = _stage(w)
    return w.sql(f"SELECT * FROM {s}")


def q09() -> str:
    w = With()
    t = _typed_payment(w)
    return w.sql(f"""
SELECT user_id, pay_doc_type, pay_doc_num, account, phone, billing_period, pay_date, sum,
  CAST(user_id AS VARCHAR) AS user_key, CAST(account AS VARCHAR) AS account_key,
  CAST(billing_period AS VARCHAR) AS billing_period_key, '{RECORD_SOURCE}' AS record_source,
  {_hk('user_id')} AS user_pk, {_hk('account')} AS account_pk, {_hk('billing_period')} AS billing_period_pk,
  {_hk('user_id', 'account', 'billing_period')} AS pay_pk,
  {_hd('phone')} AS user_hashdiff,
  DATE '{V2_LOAD_DATE[:10]}' AS load_date, pay_date AS effective_from
FROM {t}""")


def _batch(w: With, year: int) -> str:
    s = _stage(w)
    w.add(f"batch_{year}", f"SELECT * FROM {s} WHERE load_date = TIMESTAMP '{year}-01-01 00:00:00'")
    return f"batch_{year}"


# ------------------------------------------------------------------ hubs and links, year by year

HUBS = {
    "hub_user": ("user_pk", ["user_key"]),
    "hub_account": ("account_pk", ["account_key"]),
    "hub_billing_period": ("billing_period_pk", ["billing_period_key"]),
    "hub_pay_doc": ("pay_doc_pk", ["pay_doc_type_key", "pay_doc_num_key"]),
}


def _empty(cols_types: list[tuple[str, str]]) -> str:
    return "SELECT " + ", ".join(f"CAST(NULL AS {t}) AS {c}" for c, t in cols_types) + " WHERE false"


def _new_keys(batch: str, state: str | None, pk: str, cols: list[str]) -> str:
    """One row (the least) for each key of a batch that the state lacks."""
    known = f"WHERE NOT EXISTS (FROM {state} AS s WHERE s.{pk} = {batch}.{pk})" if state else ""
    least = ", ".join(f"{c} NULLS FIRST" for c in ["load_date", *cols])
    return f"SELECT DISTINCT ON ({pk}) {', '.join(cols)} FROM {batch} {known} ORDER BY {pk}, {least}"


def _hub_chain(w: With, name: str, source=None) -> str:
    """Yearly hub loads 1995..2001; returns the final hub's CTE name."""
    pk, keys = HUBS[name]
    cols = [pk, *keys, "load_date", "record_source"]
    prev = f"{name}_0"
    w.add(prev, _empty([(pk, "VARCHAR")] + [(k, "VARCHAR") for k in keys]
                       + [("load_date", "TIMESTAMP"), ("record_source", "VARCHAR")]))
    for y in YEARS:
        b = _batch(w, y)
        ins = f"{name}_ins_{y}"
        w.add(ins, _new_keys(b, prev, pk, cols))
        cur = f"{name}_{y}"
        w.add(cur, f"SELECT * FROM {prev} UNION ALL SELECT * FROM {ins}")
        prev = cur
    return prev


def hub_query(name: str) -> str:
    w = With()
    return w.sql(f"SELECT * FROM {_hub_chain(w, name)}")


LINK_PK = "user_account_billing_pay_pk"
LINK_COLS = [LINK_PK, "user_pk", "account_pk", "billing_period_pk", "pay_doc_pk", "load_date",
             "record_source"]


def _link_chain(w: With) -> str:
    prev = "link_0"
    w.add(prev, _empty([(c, "VARCHAR") for c in LINK_COLS[:5]]
                       + [("load_date", "TIMESTAMP"), ("record_source", "VARCHAR")]))
    for y in YEARS:
        b = _batch(w, y)
        ins = f"link_ins_{y}"
        w.add(ins, f"""
SELECT {', '.join(LINK_COLS)} FROM {b}
WHERE NOT EXISTS (FROM {prev} AS s WHERE s.{LINK_PK} = {b}.{LINK_PK})
GROUP BY ALL""")
        cur = f"link_{y}"
        w.add(cur, f"SELECT * FROM {prev} UNION ALL SELECT * FROM {ins}")
        prev = cur
    return prev


def q15() -> str:
    w = With()
    return w.sql(f"SELECT * FROM {_link_chain(w)}")


# ------------------------------------------------------------------ satellites, year by year

SATS = {
    "sat_user_details": ("user_pk", "user_hashdiff", ["phone"],
                         [("user_pk", "VARCHAR"), ("user_hashdiff", "VARCHAR"), ("phone", "VARCHAR")]),
    "sat_pay_details": (LINK_PK, "pay_doc_hashdiff", ["pay_date", "sum"],
                        [(LINK_PK, "VARCHAR"), ("pay_doc_hashdiff", "VARCHAR"), ("pay_date", "DATE"),
                         ("sum", "DECIMAL(10,2)")]),
}


def _sat_chain(w: With, name: str) -> str:
    pk, hd, payload, types = SATS[name]
    cols = [pk, hd, *payload, "effective_from", "load_date", "record_source"]
    prev = f"{name}_0"
    w.add(prev, _empty(types + [("effective_from", "DATE"), ("load_date", "TIMESTAMP"),
                                ("record_source", "VARCHAR")]))
    for y in YEARS:
        b = _batch(w, y)
        # a key's newest stored load that is not later than the batch
        newest = f"{name}_newest_{y}"
        w.add(newest, f"""
SELECT {pk}, max(load_date) AS load_date FROM {prev}
WHERE load_date <= TIMESTAMP '{y}-01-01 00:00:00' GROUP BY {pk}""")
        current = f"{name}_current_{y}"
        w.add(current, f"SELECT {pk}, {hd} FROM {prev} SEMI JOIN {newest} USING ({pk}, load_date)")
        ins = f"{name}_ins_{y}"
        w.add(ins, f"""
SELECT {', '.join(cols)} FROM {b}
WHERE NOT EXISTS (FROM {current} AS s WHERE s.{pk} = {b}.{pk} AND s.{hd} = {b}.{hd})
GROUP BY ALL""")
        cur = f"{name}_{y}"
        w.add(cur, f"SELECT * FROM {prev} UNION ALL SELECT * FROM {ins}")
        prev = cur
    return prev


def sat_query(name: str) -> str:
    w = With()
    return w.sql(f"SELECT * FROM {_sat_chain(w, name)}")


# ------------------------------------------------------------------ report (variant A)

def _report(w: With) -> str:
    link = _link_chain(w)
    hbp = _hub_chain(w, "hub_billing_period")
    sat = _sat_chain(w, "sat_pay_details")
    hu = _hub_chain(w, "hub_user")
    w.stg("mdm_user")
    w.add("paid", f"""
SELECT user_key, CAST(left(billing_period_key, 4) AS INTEGER) AS billing_year, {sat}.sum AS amount
FROM {link} JOIN {sat} USING ({LINK_PK}) JOIN {hbp} USING (billing_period_pk) JOIN {hu} USING (user_pk)""")
    w.add("person", """
SELECT CAST(id AS VARCHAR) AS user_key, legal_type, district, registered_at, is_vip FROM mdm_user""")
    w.add("report", _revenue("paid", "person", "user_key"))
    return "report"


def _revenue(paid: str, person: str, key: str) -> str:
    """Sums by billing year and the payer's attributes (NULL for unknown payers)."""
    return f"""
SELECT billing_year, legal_type, district, CAST(year(registered_at) AS INTEGER) AS registration_year, is_vip,
  CAST(sum(amount) AS DECIMAL(20,2)) AS sum
FROM {paid} LEFT JOIN {person} USING ({key}) WHERE billing_year IS NOT NULL
GROUP BY ALL"""


def q21() -> str:
    w = With()
    return w.sql(f"SELECT * FROM {_report(w)}")


DIMS = {
    "dim_billing_year": ("billing_year", "billing_year_key", "INTEGER"),
    "dim_legal_type": ("legal_type", "legal_type_key", "VARCHAR"),
    "dim_district": ("district", "district_key", "VARCHAR"),
    "dim_registration_year": ("registration_year", "registration_year_key", "VARCHAR"),
}


DIMS_B = {**DIMS, "dim_registration_year": ("registration_year", "registration_year_key", "INTEGER")}


def _dim_chain(w: With, name: str, report: str, spec=None, prefix: str = "") -> str:
    column, key, ktype = (spec or DIMS)[name]
    name = prefix + name
    prev = f"{name}_0"
    w.add(prev, _empty([("id", "BIGINT"), (key, ktype)]))
    for y in YEARS:
        ins = f"{name}_ins_{y}"
        w.add(f"{ins}_values", f"""
SELECT DISTINCT CAST({column} AS {ktype}) AS value FROM {report} WHERE billing_year = {y}""")
        w.add(ins, f"""
SELECT CAST(row_number() OVER (ORDER BY value NULLS LAST) + (SELECT count(*) FROM {prev}) AS BIGINT) AS id,
  value AS {key}
FROM {ins}_values WHERE NOT EXISTS (FROM {prev} AS s WHERE s.{key} = value)""")
        cur = f"{name}_{y}"
        w.add(cur, f"SELECT * FROM {prev} UNION ALL SELECT * FROM {ins}")
        prev = cur
    return prev


def dim_query(name: str) -> str:
    w = With()
    r = _report(w)
    return w.sql(f"SELECT * FROM {_dim_chain(w, name, r)}")


def _fact(report: str, dims: dict[str, str], spec: dict) -> str:
    """The report with each attribute replaced by the id of its dimension row."""
    ids = ", ".join(f"{dims[n]}.id AS {column}_id" for n, (column, _, _) in spec.items())
    lookups = " ".join(f"JOIN {dims[n]} ON {dims[n]}.{key} = CAST({report}.{column} AS {ktype})"
                       for n, (column, key, ktype) in spec.items())
    return f"SELECT {ids}, is_vip, sum FROM {report} {lookups}"


def q27() -> str:
    w = With()
    r = _report(w)
    return w.sql(_fact(r, {n: _dim_chain(w, n, r) for n in DIMS}, DIMS))


# ------------------------------------------------------------------ second vault (one run, whole ODS)

def _stage_v2(w: With) -> str:
    """The whole typed ODS, rows without a date included."""
    w.stg("stg_payment_typed")
    w.add("stage_v2", f"""
SELECT user_id, pay_doc_type, pay_doc_num, account, phone, billing_period, pay_date, sum,
  CAST(user_id AS VARCHAR) AS user_key, CAST(account AS VARCHAR) AS account_key,
  CAST(billing_period AS VARCHAR) AS billing_period_key, '{RECORD_SOURCE}' AS record_source,
  {_hk('user_id')} AS user_pk, {_hk('account')} AS account_pk,
  {_hk('billing_period')} AS billing_period_pk,
  {_hk('pay_doc_type', 'pay_doc_num')} AS pay_pk, {_hk('pay_doc_type')} AS pay_doc_type_id,
  TIMESTAMP '{V2_LOAD_DATE}' AS load_date, pay_date AS effective_from
FROM stg_payment_typed""")
    return "stage_v2"


def _first_row_hub(w: With, name: str, pk: str, keys: list[str], stage: str) -> str:
    w.add(name, _new_keys(stage, None, pk, [pk, *keys, "load_date", "record_source"]))
    return name


def q14() -> str:
    w = With()
    s = _stage_v2(w)
    return w.sql(f"SELECT * FROM {_first_row_hub(w, 'v2_hub_payment', 'pay_pk', ['pay_doc_type_id', 'pay_doc_num'], s)}")


T_LINK_COLS = ["pay_pk", "user_pk", "account_pk", "billing_period_pk", "sum", "pay_doc_type",
               "pay_doc_num", "effective_from", "load_date", "record_source"]


def _t_link(w: With) -> str:
    s = _stage_v2(w)
    w.add("v2_t_link", f"SELECT DISTINCT {', '.join(T_LINK_COLS)} FROM {s}")
    return "v2_t_link"


def q16() -> str:
    w = With()
    return w.sql(f"SELECT * FROM {_t_link(w)}")


def q19() -> str:
    w = With()
    s = _stage_v2(w)
    return w.sql(f"SELECT DISTINCT {_hk('pay_doc_type')} AS pk_id, pay_doc_type FROM {s}")


def _sat_client(w: With) -> str:
    s = _stage_v2(w)
    hu = _first_row_hub(w, "v2_hub_user", "user_pk", ["user_key"], s)
    w.stg("mdm_user")
    w.add("v2_sat_client", f"""
SELECT DISTINCT {_hk('id')} AS user_pk, legal_type, district, registered_at, billing_mode, is_vip,
  TIMESTAMP '{V2_LOAD_DATE}' AS load_date, '{MDM_RECORD_SOURCE}' AS record_source
FROM mdm_user WHERE {_hk('id')} IN (SELECT user_pk FROM {hu})""")
    return "v2_sat_client"


def q20() -> str:
    w = With()
    return w.sql(f"SELECT * FROM {_sat_client(w)}")


def _report_v2(w: With) -> str:
    tl = _t_link(w)
    s = _stage_v2(w)
    hbp = _first_row_hub(w, "v2_hub_bp", "billing_period_pk", ["billing_period_key"], s)
    hu = _first_row_hub(w, "v2_hub_user", "user_pk", ["user_key"], s)
    sc = _sat_client(w)
    w.add("paid_v2", f"""
SELECT user_pk, CAST(left(billing_period_key, 4) AS INTEGER) AS billing_year, {tl}.sum AS amount
FROM {tl} JOIN {hbp} USING (billing_period_pk) SEMI JOIN {hu} USING (user_pk)""")
    w.add("report_v2", _revenue("paid_v2", sc, "user_pk"))
    return "report_v2"


CLIENT = ["legal_type", "district", "registered_at", "billing_mode", "is_vip"]


def _reports_v2(w: With) -> str:
    """The reports of the combined runs: each run reloads its year, loads all
    reloaded years with its own LOAD_DATE into the tables the runs before it left,
    and reports the payments of its billing year that are stored by then."""
    stage = _stage_v2(w)
    w.stg("mdm_user")
    links, clients, reports = "run_links_0", "run_clients_0", []
    w.add(links, f"SELECT {', '.join(T_LINK_COLS)} FROM {stage} WHERE false")
    w.add(clients, f"SELECT {_hk('id')} AS user_pk, {', '.join(CLIENT)} FROM mdm_user WHERE false")
    for y in YEARS:
        batch, periods = f"reloaded_{y}", f"run_periods_{y}"
        w.add(batch, f"""
SELECT * REPLACE (TIMESTAMP '{y}-01-01 00:00:00' AS load_date) FROM {stage} WHERE year(pay_date) <= {y}""")
        w.add(f"run_links_{y}", f"""
SELECT * FROM {links} UNION ALL
SELECT DISTINCT {', '.join(T_LINK_COLS)} FROM {batch}
WHERE NOT EXISTS (FROM {links} AS s WHERE s.pay_pk = {batch}.pay_pk)""")
        # a version is stored if the client has none with the same attributes
        same = " AND ".join(f"s.{c} IS NOT DISTINCT FROM m.{c}" for c in CLIENT)
        w.add(f"run_clients_{y}", f"""
SELECT * FROM {clients} UNION ALL
SELECT DISTINCT {_hk('id')}, {', '.join(CLIENT)} FROM mdm_user AS m
WHERE {_hk('id')} IN (SELECT user_pk FROM {batch} WHERE user_pk IS NOT NULL)
  AND NOT EXISTS (FROM {clients} AS s WHERE s.user_pk = {_hk('m.id')} AND {same})""")
        links, clients = f"run_links_{y}", f"run_clients_{y}"
        w.add(periods, _new_keys(batch, None, "billing_period_pk",
                                 ["billing_period_pk", "billing_period_key", "load_date", "record_source"]))
        w.add(f"run_paid_{y}", f"""
SELECT user_pk, {y} AS billing_year, {links}.sum AS amount FROM {links} JOIN {periods} USING (billing_period_pk)
WHERE user_pk IS NOT NULL AND CAST(left(billing_period_key, 4) AS INTEGER) = {y}""")
        w.add(f"run_report_{y}", _revenue(f"run_paid_{y}", clients, "user_pk"))
        reports.append(f"SELECT * FROM run_report_{y}")
    w.add("run_reports", " UNION ALL ".join(reports))
    return "run_reports"


def q29() -> str:
    """Combined run: the report of each yearly run, then variant-B dimensions
    (registration year kept as a number) and the fact."""
    w = With()
    r = _reports_v2(w)
    return w.sql(_fact(r, {n: _dim_chain(w, n, r, spec=DIMS_B, prefix="b_") for n in DIMS_B}, DIMS_B))


def q22() -> str:
    w = With()
    return w.sql(f"SELECT * FROM {_report_v2(w)}")


# ------------------------------------------------------------------ yearly form, two batches

def of_year(sql: str, year: int) -> str:
    return f"SELECT * FROM ({sql}) WHERE year = '{year}'"


def _loads(w: With, second: bool) -> list[str]:
    """The two batches as CTEs; a row without a date is in both of the second vault's."""
    stage = _stage_v2(w) if second else _stage(w)
    return [w.add(label, f"SELECT * REPLACE (TIMESTAMP '{at}' AS load_date) FROM {stage} "
                         f"WHERE pay_date IS NULL OR year(pay_date) {span}") and label
            for label, at, span in LOADS]


def two_hub(pk: str, keys: list[str], second: bool = False) -> str:
    w = With()
    early, late = _loads(w, second)
    cols = [pk, *keys, "load_date", "record_source"]
    w.add("known", _new_keys(early, None, pk, cols)).add("more", _new_keys(late, "known", pk, cols))
    return w.sql("SELECT * FROM known UNION ALL SELECT * FROM more")


def two_distinct(pk: str, cols: str, second: bool = False, pk_expr: str | None = None) -> str:
    """Distinct rows of the first batch, and those of the second with new keys."""
    w = With()
    early, late = _loads(w, second)
    given = f"{pk_expr} AS {pk}, {cols}" if pk_expr else f"{pk}, {cols}"
    w.add("known", f"SELECT DISTINCT {given} FROM {early}")
    w.add("later", f"SELECT DISTINCT {given} FROM {late}")
    return w.sql(f"SELECT * FROM known UNION ALL FROM later WHERE NOT EXISTS (FROM known AS k WHERE k.{pk} = later.{pk})")


def two_sat(name: str) -> str:
    """All versions stored first have one load date, so all of them are the newest."""
    pk, hd, payload, _ = SATS[name]
    w = With()
    early, late = _loads(w, False)
    cols = ", ".join([pk, hd, *payload, "effective_from", "load_date", "record_source"])
    w.add("known", f"SELECT DISTINCT {cols} FROM {early}").add("later", f"SELECT DISTINCT {cols} FROM {late}")
    return w.sql(f"""
SELECT * FROM known UNION ALL
FROM later WHERE NOT EXISTS (FROM known AS k WHERE k.{pk} = later.{pk} AND k.{hd} = later.{hd})""")


def two_client() -> str:
    """Clients of the users known after each batch; the second time those are stored
    that were not, or whose id is a multiple of five (their billing mode changed)."""
    w = With().stg("mdm_user")
    early, late = _loads(w, True)
    attributes = "legal_type, district, registered_at"

    def clients(mode, at, batches):
        users = " UNION ALL ".join(f"SELECT user_pk FROM {b}" for b in batches)
        return (f"SELECT {_hk('id')} AS user_pk, {attributes}, {mode} AS billing_mode, is_vip, TIMESTAMP '{at}' AS load_date, "
                f"'{MDM_RECORD_SOURCE}' AS record_source FROM mdm_user WHERE {_hk('id')} IN ({users})")

    w.add("known", clients("billing_mode", LOADS[0][1], [early]))
    w.add("later", clients("CASE WHEN id % 5 = 0 THEN 'TRIAL' ELSE billing_mode END", LOADS[1][1], [early, late]))
    return w.sql("""
SELECT * FROM known UNION ALL
FROM later WHERE billing_mode = 'TRIAL' OR user_pk NOT IN (SELECT user_pk FROM known)""")


def two_dim(name: str) -> str:
    """Values of the years to the overlap, numbered in order, then the new ones."""
    column, key, ktype = DIMS[name]
    w = With()
    r = _report(w)
    for label, _, span in LOADS:
        w.add(f"{label}_values", f"SELECT DISTINCT CAST({column} AS {ktype}) AS value FROM {r} WHERE billing_year {span}")
    number = "row_number() OVER (ORDER BY value NULLS LAST)"
    w.add("known", f"SELECT {number} AS id, value AS {key} FROM early_values")
    return w.sql(f"""
SELECT * FROM known UNION ALL
SELECT {number} + (SELECT count(*) FROM known), value FROM late_values
WHERE NOT EXISTS (FROM known WHERE {key} = value)""")


def all_sql() -> dict[str, str]:
    return {
        "Q01_ods_billing": q01(),
        "Q02_ods_issue": q02(),
        "Q03_ods_payment": q03(),
        "Q04_ods_traffic": q04(),
        "Q05_dm_bytes_received": q05(),
        "Q06_ods_payment_copy": q06(),
        "Q07_ods_payment_reload": q07(),
        "S02_multi_directory_scan": q06(),
        "Q08_payment_stage": q08(),
        "Q09_payment_stage_all": q09(),
        "Q10_hub_user": hub_query("hub_user"),
        "Q11_hub_account": hub_query("hub_account"),
        "Q12_hub_billing_period": hub_query("hub_billing_period"),
        "Q13_hub_pay_doc": hub_query("hub_pay_doc"),
        "Q14_hub_payment": q14(),
        "Q15_link_user_account_billing_pay": q15(),
        "Q16_t_link_payment": q16(),
        "Q17_sat_user_details": sat_query("sat_user_details"),
        "Q18_sat_pay_details": sat_query("sat_pay_details"),
        "Q19_sat_payment_doc_type": q19(),
        "Q20_sat_user_as_client": q20(),
        "Q21_payment_report": q21(),
        "Q22_payment_report_client": q22(),
        "Q23_dim_billing_year": dim_query("dim_billing_year"),
        "Q24_dim_legal_type": dim_query("dim_legal_type"),
        "Q25_dim_district": dim_query("dim_district"),
        "Q26_dim_registration_year": dim_query("dim_registration_year"),
        "Q27_report_fact": q27(),
        "Q28_backfill": q27(),
        "Q29_combined_run_second_vault": q29(),
        "Q01_ods_billing_year": of_year(q01(), LAKE_YEAR),
        "Q02_ods_issue_year": of_year(q02(), EVENT_YEAR),
        "Q03_ods_payment_year": of_year(q03(), LAKE_YEAR),
        "Q04_ods_traffic_year": of_year(q04(), EVENT_YEAR),
        "Q05_dm_bytes_received_year": of_year(q05(), EVENT_YEAR),
        **{f"Q{10 + i}_{name}_two_batches": two_hub(pk, keys) for i, (name, (pk, keys)) in enumerate(HUBS.items())},
        "Q14_hub_payment_two_batches": two_hub("pay_pk", ["pay_doc_type_id", "pay_doc_num"], second=True),
        "Q15_link_two_batches": two_distinct(LINK_PK, ", ".join(LINK_COLS[1:])),
        "Q16_t_link_payment_two_batches": two_distinct("pay_pk", ", ".join(T_LINK_COLS[1:]), second=True),
        "Q17_sat_user_details_two_batches": two_sat("sat_user_details"),
        "Q18_sat_pay_details_two_batches": two_sat("sat_pay_details"),
        "Q19_sat_payment_doc_type_two_batches": two_distinct("pk_id", "pay_doc_type", second=True,
                                                             pk_expr=_hk("pay_doc_type")),
        "Q20_sat_user_as_client_two_batches": two_client(),
        **{f"Q{23 + i}_{name}_two_batches": two_dim(name) for i, name in enumerate(DIMS)},
    }
