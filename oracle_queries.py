"""The checks as DuckDB SQL, written the way the definitions read.

Where the engine sums per entity, per day or per pair before it joins, the
queries here use the plain joins and ``count(distinct ...)``, so that the two
sides agree only if both are right.

A ``Scope`` says which months a query covers.  Its CTEs are

* ``ev``     event rows in scope with the reporting month ``m``,
* ``em``     all event rows with their own refresh month ``m``,
* ``spine``  the reporting months.
"""

from __future__ import annotations

from dataclasses import dataclass

import claim_views as cv
from refreshguard.functions import months

AS_OF = f"date '{cv.AS_OF}'"
MONTH_DATE = f"date '{months.first_day(cv.MONTH)}'"

MX = {
    "table": "mx_events", "id": "medical_event_id", "day": "service_date",
    "required": ["medical_event_id", "patient_id", "service_date", "procedure_code", "billing_npi"],
    "optional": ["service_to_date", "units", "unit_type", "rendering_npi", "referring_npi", "ndc11"],
    "dup": ["patient_id", "service_date", "procedure_code"],
    "npis": ["billing_npi", "rendering_npi", "referring_npi"],
    "roles": {"code": "procedure_code", "provider": "rendering_npi",
              "organization": "billing_npi", "payer": "kh_plan_id", "cohort": "cohort_id"},
    "cohort": "mx_cohort",
}
RX = {
    "table": "rx_events", "id": "pharmacy_event_id", "day": "fill_date",
    "required": ["pharmacy_event_id", "patient_id", "fill_date", "diagnosis_code", "pharmacy_npi"],
    "optional": ["ndc11", "days_supply", "quantity", "prescriber_npi", "brand_name",
                 "generic_name", "date_prescription_written"],
    "absent": ["route", "transaction_result", "reject_codes", "transaction_number",
               "transaction_status", "fill_number", "number_of_refills_authorized", "daw_code",
               "primary_kh_plan_id", "secondary_kh_plan_id", "patient_responsibility",
               "patient_oop"],
    "dup": ["patient_id", "fill_date", "ndc11"],
    "npis": ["pharmacy_npi", "prescriber_npi"],
    "roles": {"code": "ndc11", "provider": "prescriber_npi", "organization": "pharmacy_npi"},
    "cohort": "rx_cohort",
}
DIMENSIONS = ("patient_demo", "patient_enroll", "patient_geo", "patient_mortality", "providers")


@dataclass(frozen=True)
class Scope:
    table: dict
    kind: str = "all"            # all, month, range
    month: str = MONTH_DATE
    old_year: int = 1900
    age_year: int = cv.AS_OF.year
    exact: bool = False
    every: bool = False          # all snapshots of a dimension, whatever the month

    def ctes(self, body: str = "") -> str:
        """The CTEs a text mentions, in order."""
        name = self.table["table"]
        own = "cast(date_trunc('month', kh_refresh_date) as date)"
        if self.kind == "range":
            spine = (f"select cast(range as date) as m from range(date '{cv.FIRST_MONTH}-01', "
                     f"date '{cv.LAST_MONTH}-02', interval 1 month)")
            ev = f"select {own} as m, * from src"
        else:
            spine = f"select {self.month} as m"
            ev = f"select {self.month} as m, * from src"
            if self.kind == "month":
                ev += (f" where kh_refresh_date >= {self.month} "
                       f"and kh_refresh_date < {self.month} + interval 1 month")
        parts = [f"src as ({cv.oracle_view(name)})", f"spine as ({spine})", f"ev as ({ev})",
                 f"em as (select {own} as m, * from src)"]
        seen = ("d.kh_refresh_date >= s.m and d.kh_refresh_date < s.m + interval 1 month"
                if self.exact else "true" if self.every else "d.kh_refresh_date < s.m + interval 1 month")
        for d in DIMENSIONS:
            if f"{d}_m" in body:
                parts.append(f"{d}_m as (select s.m, d.* from ({cv.oracle_view(d)}) d "
                             f"join spine s on {seen})")
        return "with " + ",\n".join(parts) + "\n"


def pct(a: str, b: str) -> str:
    return f"(case when {b} > 0 then cast({a} as double) / {b} * 100 else 0.0 end)"


def chg(cur: str, prev: str) -> str:
    return f"(case when {prev} > 0 then cast({cur} - {prev} as double) / {prev} * 100 end)"


def bad(condition: str, word: str) -> str:
    return f"case when {condition} then '{word}' else 'PASS' end"


def row(category, check, metric, num="null", den="null", value="null", status="'INFO'", keep=None):
    where = f" where {keep}" if keep else ""
    check = check if check.startswith("(") else f"'{check}'"
    metric = metric if metric.startswith("(") else f"'{metric}'"
    return (f"select m, '{category}' as check_category, {check} as check_name, "
            f"{metric} as metric_name, cast({num} as bigint) as num, cast({den} as bigint) as den, "
            f"round(cast({value} as double), 4) as value, {status} as status from w{where}")


def block(wide: str, rows: list[str]) -> str:
    return f"(with w as ({wide}) " + " union all ".join(rows) + ")"


def spined(inner: str, columns: list[str]) -> str:
    """Left join the months to per-month counts, 0 where there are none."""
    filled = ", ".join(f"coalesce({c}, 0) as {c}" for c in columns)
    return f"select s.m, {filled} from spine s left join ({inner}) t on t.m = s.m"


# -- one pass -------------------------------------------------------------

def _scan(counts: dict[str, str]) -> str:
    inner = ", ".join(f"count(*) filter (where {c}) as {n}" for n, c in counts.items())
    return spined(f"select m, count(*) as n{', ' + inner if inner else ''} from ev group by m",
                  ["n", *counts])


def completeness(s: Scope) -> list[str]:
    t = s.table
    counts = {f"null_{c}": f"{c} is null" for c in [*t["required"], *t["optional"]]}
    if t is MX:
        counts["code_missing"] = "procedure_code is null and procedure_code_type is not null"
    rows = []
    for c in t["required"]:
        n = f"null_{c}"
        rows.append(row("completeness", "required_fields", f"{c}_null_percentage", n, "n",
                        pct(n, "n"), bad(f"{n} > 0", "FAIL")))
        rows.append(row("completeness", "required_fields", f"{c}_null_count", n, "n", n,
                        f"case when n = 0 then 'INFO' when {n} > 0 then 'FAIL' else 'PASS' end"))
    for c in t["optional"]:
        n = f"null_{c}"
        rows.append(row("completeness", "optional_fields", f"{c}_null_percentage", n, "n",
                        pct(n, "n"), bad(f"{pct(n, 'n')} > 5.0", "WARN")))
    if t is MX:
        rows.append(row("completeness", "procedure_code_type_consistency", "inconsistent_count",
                        "code_missing", "n", "code_missing", bad("code_missing > 0", "WARN")))
    return [block(_scan(counts), rows)]


def validity(s: Scope) -> list[str]:
    t, day = s.table, s.table["day"]
    npi = {c: f"{c} is not null and (length({c}) <> 10 or regexp_matches({c}, '[^0-9]'))"
           for c in t["npis"]}
    rules = [
        ("future_dates", "future_date", f"{day} > {AS_OF}", "FAIL"),
        ("old_dates", "old_date", f"year({day}) < {s.old_year}", "WARN"),
        ("ndc_format", "invalid_ndc",
         "ndc11 is not null and length(replace(ndc11, '-', '')) <> 11", "WARN")]
    if t is MX:
        rules += [
            ("procedure_code_type", "invalid_proc_type",
             "procedure_code_type is not null and upper(procedure_code_type) not in ('CPT', "
             "'HCPCS', 'ICD-10-PCS', 'ICD-9-PCS', 'NDC', 'LOINC', 'OTHER')", "WARN"),
            ("units_positive", "negative_units", "units <= 0", "FAIL"),
            ("units_extreme", "extreme_units", "units > 9999", "WARN"),
            ("unit_type", "invalid_unit_type", "unit_type is not null and upper(unit_type) "
             "not in ('ML', 'UN', 'GR', 'F2', 'ME', 'OTHER')", "WARN"),
            ("future_service_to_date", "future_service_to_date",
             f"service_to_date > {AS_OF}", "FAIL")]
    else:
        rules += [
            ("quantity_positive", "negative_quantity", "quantity <= 0", "FAIL"),
            ("quantity_extreme", "extreme_quantity", "quantity > 9999", "WARN"),
            ("days_supply_positive", "negative_days", "days_supply <= 0", "FAIL"),
            ("fill_date_order", "invalid_order", "date_prescription_written is not null "
             "and fill_date < date_prescription_written", "WARN")]
    rules += [(f"{c}_format", f"invalid_{c}", rule, "WARN") for c, rule in npi.items()]
    counts = {name: rule for _, name, rule, _ in rules}
    rows = []
    for check, name, _, word in rules:
        status = bad(f"{name} > 0", word)
        rows.append(row("validity", check, f"{name}_percent", name, "n", pct(name, "n"), status,
                        "n > 0"))
        rows.append(row("validity", check, f"{name}_count", name, "n", name, status, "n > 0"))
    rows.append(row("validity", "overall_validity", "status", keep="n = 0"))
    return [block(_scan(counts), rows)]


def date_order(s: Scope) -> list[str]:
    if s.table is MX:
        check, word = "service_date_order", "FAIL"
        rule = "service_to_date is not null and service_date > service_to_date"
    else:
        check, word = "fill_date_order", "WARN"
        rule = "date_prescription_written is not null and fill_date < date_prescription_written"
    return [block(_scan({"x": rule}), [row("consistency", check, "invalid_date_percent", "x", "n",
                                           pct("x", "n"), bad("x > 0", word))])]


def uniqueness(s: Scope) -> list[str]:
    t = s.table
    keys = spined(f"select m, cast(sum(c) as bigint) as n, count(*) as k, "
                  f"count(*) filter (where c > 1) as r from "
                  f"(select m, {t['id']}, count(*) as c from ev group by all) group by m",
                  ["n", "k", "r"])
    records = spined(f"select m, cast(sum(c) as bigint) as n, count(*) filter (where c > 1) as r "
                     f"from (select m, {', '.join(t['dup'])}, count(*) as c from ev group by all) "
                     f"group by m", ["n", "r"])
    return [
        block(keys, [
            row("uniqueness", "primary_key_uniqueness", f"{t['id']}_duplicate_percentage", "n - k",
                "n", pct("(n - k)", "n"), bad("n - k > 0", "FAIL")),
            row("uniqueness", "primary_key_uniqueness", f"{t['id']}_duplicate_keys", "r", "k", "r",
                bad("r > 0", "FAIL"))]),
        block(records, [row("uniqueness", "duplicate_records", "duplicate_record_percentage", "r",
                            "n", pct("r", "n"), bad("r > 0", "WARN"))])]


# -- consistency ----------------------------------------------------------

def missing_entities(s: Scope) -> list[str]:
    wide = spined(
        "select e.m, count(*) as n, count(*) filter (where d.patient_id is null) as x "
        "from (select distinct m, patient_id from ev) e "
        "left join (select distinct m, patient_id from patient_demo_m) d "
        "on d.m = e.m and d.patient_id = e.patient_id group by e.m", ["n", "x"])
    return [block(wide, [
        row("consistency", "patient_demographics", "missing_patient_percent", "x", "n",
            pct("x", "n"), bad("x > 0", "WARN")),
        row("consistency", "patient_demographics", "missing_patient_count", "x", "n", "x",
            bad("x > 0", "FAIL"))])]


def _outside(s: Scope) -> str:
    return (f"select e.m, e.{s.table['id']} as id from ev e where not exists (select 1 from "
            f"patient_enroll_m p where p.m = e.m and p.patient_id = e.patient_id and "
            f"e.{s.table['day']} >= p.start_date and e.{s.table['day']} <= p.end_date)")


def outside_enrollment(s: Scope) -> list[str]:
    wide = spined(f"select a.m, a.n, b.x from (select m, count(*) as n from ev group by m) a "
                  f"left join (select m, count(*) as x from ({_outside(s)}) group by m) b "
                  f"on b.m = a.m", ["n", "x"])
    return [block(wide, [row("consistency", "enrollment_periods", "outside_enrollment_percent",
                             "x", "n", pct("x", "n"), bad("x > 0", "WARN"))])]


def outside_events(s: Scope) -> list[str]:
    wide = spined(f"select m, count(distinct id) as x from ({_outside(s)}) group by m", ["x"])
    return [block(wide, [row("consistency", "enrollment_periods", "outside_enrollment_events",
                             "x", "null", "x", bad("x > 0", "WARN"))])]


def deaths(s: Scope) -> list[str]:
    wide = spined(
        f"select e.m, count(*) as n, count(*) filter (where e.{s.table['day']} > d.dd + 60) as x, "
        f"count(*) filter (where e.{s.table['day']} > d.dd) as y from ev e join "
        f"(select m, patient_id, patient_death_date as dd, row_number() over (partition by m, "
        f"patient_id order by kh_refresh_date desc) as rn from patient_mortality_m "
        f"where patient_death_date is not null) d on d.m = e.m and d.patient_id = e.patient_id "
        f"and d.rn = 1 group by e.m", ["n", "x", "y"])
    return [block(wide, [
        row("consistency", "mortality_dates", "after_death_percent", "x", "n", pct("x", "n"),
            bad("x > 0", "FAIL")),
        row("consistency", "mortality_dates", "after_death_count", "y", "n", "y",
            bad("y > 0", "FAIL"))])]


def providers_by_column(s: Scope) -> list[str]:
    out = []
    for c in s.table["npis"]:
        wide = spined(
            f"select e.m, count(*) as n, count(*) filter (where p.npi is null) as x from "
            f"(select distinct m, {c} as npi from ev where {c} is not null) e left join "
            f"(select distinct m, npi from providers_m) p on p.m = e.m and p.npi = e.npi "
            f"group by e.m", ["n", "x"])
        out.append(block(wide, [row("consistency", f"{c}_provider", "missing_npi_percent", "x",
                                    "n", pct("x", "n"), bad("x > 0", "WARN"))]))
    return out


def providers_pooled(s: Scope) -> list[str]:
    pool = " union ".join(f"select m, {c} as npi from ev where {c} is not null"
                          for c in s.table["npis"])
    wide = spined(
        f"select e.m, count(*) as n, count(*) filter (where p.npi is null) as x from ({pool}) e "
        f"left join (select distinct m, npi from providers_m) p on p.m = e.m and p.npi = e.npi "
        f"group by e.m", ["n", "x"])
    return [block(wide, [row("consistency", "provider_ids", "missing_npi_count", "x", "n", "x",
                             "case when n = 0 then 'INFO' when x > 0 then 'WARN' "
                             "else 'PASS' end")])]


def stability(s: Scope) -> list[str]:
    latest = ("select * from (select cast(date_trunc('month', kh_refresh_date) as date) as own, "
              "patient_id as p, patient_gender as g, patient_yob as y, row_number() over (partition "
              "by date_trunc('month', kh_refresh_date), patient_id order by kh_refresh_date desc, "
              "patient_gender desc nulls last, patient_yob desc nulls last) as rn from "
              f"({cv.oracle_view('patient_demo')}) where patient_id is not null) where rn = 1")
    wide = spined(f"select c.own as m, count(*) as n, count(*) filter (where c.g is distinct from "
                  f"q.g) as gc, count(*) filter (where c.y is distinct from q.y) as yc from ({latest}) "
                  f"c join ({latest}) q on c.p = q.p and q.own = c.own - interval 1 month "
                  f"group by c.own", ["n", "gc", "yc"])
    return [block(wide, [row("consistency", "demographic_stability", f"{c}_changed_percent", x, "n",
                             pct(x, "n"), bad(f"{x} > 0", "WARN"))
                         for c, x in (("gender", "gc"), ("birth", "yc"))])]


# -- distribution ---------------------------------------------------------

AGE = ("case when age < 18 then '0-17' when age < 45 then '18-44' when age < 65 then '45-64' "
       "when age >= 65 then '65+' else 'Unknown' end")
GROUPS = ("0-17", "18-44", "45-64", "65+", "Unknown")


def latest_demo(s: Scope) -> str:
    return (f"select m, patient_id, g, {AGE} as a from (select m, patient_id, "
            f"upper(patient_gender) as g, {s.age_year} - patient_yob as age, row_number() over "
            f"(partition by m, patient_id order by kh_refresh_date desc) as rn "
            f"from patient_demo_m) where rn = 1")


def _demo(s: Scope, per_event: bool, prefix: str, what: str) -> list[str]:
    base = "ev" if per_event else "(select distinct m, patient_id from ev)"
    kind = "join" if per_event else "left join"
    cols = {"total": "true", "f": "d.g = 'F'", "ma": "d.g = 'M'",
            "o": "d.g is null or d.g not in ('F', 'M')"}
    cols |= {f"a{i}": f"d.a = '{g}'" for i, g in enumerate(GROUPS)}
    counts = ", ".join(f"count(*) filter (where {c}) as {n}" for n, c in cols.items())
    wide = spined(f"select e.m, {counts} from {base} e {kind} ({latest_demo(s)}) d on d.m = e.m "
                  f"and d.patient_id = e.patient_id group by e.m", list(cols))
    rows = []
    if what != "age":
        for key, n in (("F", "f"), ("M", "ma"), ("other", "o")):
            rows.append(row("distribution", f"{prefix}gender_distribution", f"share_{key}", n,
                            "total", pct(n, "total"), keep=f"{n} > 0"))
        rows.append(row("distribution", f"{prefix}gender_distribution", "distribution", "null",
                        "total", keep="total > 0"))
        rows.append(row("distribution", f"{prefix}gender_distribution", "status",
                        keep="total = 0"))
    if what != "gender":
        odd = " or ".join(f"{pct(f'a{i}', 'total')} < 5" for i in range(4))
        status = "'INFO'" if per_event else bad(f"{odd} or {pct('a4', 'total')} > 10", "WARN")
        for i, key in enumerate(GROUPS):
            rows.append(row("distribution", f"{prefix}age_distribution", f"share_{key}", f"a{i}",
                            "total", pct(f"a{i}", "total"), status, keep=f"a{i} > 0"))
        rows.append(row("distribution", f"{prefix}age_distribution", "distribution", "null",
                        "total", "null", status, keep="total > 0"))
        rows.append(row("distribution", f"{prefix}age_distribution", "status", keep="total = 0"))
    return [block(wide, rows)]


def gender(s):
    return _demo(s, False, "", "gender")


def age(s):
    return _demo(s, False, "", "age")


def event_demo(s):
    return _demo(s, True, "event_", "both")


def state_counts(s: Scope) -> str:
    return (f"select e.m, g.patient_state as k, count(*) as n from ev e left join "
            f"(select * from patient_geo_m where valid_from_date is not null and valid_to_date "
            f"is not null and patient_state is not null) g on g.m = e.m and g.patient_id = "
            f"e.patient_id and e.{s.table['day']} between g.valid_from_date and g.valid_to_date "
            f"group by e.m, g.patient_state")


def event_state_counts(s: Scope) -> str:
    return (f"select m, k, count(*) as n from (select distinct e.m, e.{s.table['id']} as id, "
            f"g.patient_state as k from ev e join patient_geo_m g on g.m = e.m and g.patient_id "
            f"= e.patient_id and e.{s.table['day']} between g.valid_from_date and "
            f"g.valid_to_date) group by m, k")


def provider_counts(s: Scope, column: str) -> str:
    return (f"select m, {column} as k, count(*) as n from ev where {column} is not null "
            f"group by m, {column}")


def cohort_counts(s: Scope) -> str:
    c = s.table["cohort"]
    return (f"select m, {c} as k, count(*) as n, count(distinct patient_id) as p from ev "
            f"where {c} is not null group by m, {c}")


def top_rows(counts: str, order: str = "n", k: int = 10, extra: str = "") -> str:
    return (f"select m, {extra}k, n, {order} as o, total from (select *, row_number() over "
            f"(partition by m order by {order} desc, k nulls first) as rn, cast(sum(n) over "
            f"(partition by m) as bigint) as total from ({counts})) where rn <= {k}")


def _summary(check: str, counts: str, limit: float | None, order: str = "n") -> str:
    first = (f"select m, n, total from (select *, row_number() over (partition by m order by o "
             f"desc, k nulls first) as rn from ({top_rows(counts, order)})) where rn = 1")
    wide = spined(first, ["n", "total"])
    status = "'INFO'" if limit is None else bad(f"{pct('n', 'total')} > {limit}", "WARN")
    return block(wide, [
        row("distribution", check, "distribution", "null", "total", pct("n", "total"), status,
            "total > 0"),
        row("distribution", check, "status", keep="total = 0")])


def distribution_tops(s: Scope) -> list[str]:
    out = [_summary("state_distribution", state_counts(s), 50),
           _summary("event_state_distribution", event_state_counts(s), None)]
    out += [_summary(f"{c}_distribution", provider_counts(s, c), 20) for c in s.table["npis"]]
    out.append(_summary("cohort_distribution", cohort_counts(s), 50, "p"))
    return out


# -- temporal -------------------------------------------------------------

CUR = "(select distinct m, patient_id as p from em)"
PREV = "(select distinct cast(m + interval 1 month as date) as m, patient_id as p from em)"


def _entities() -> str:
    return f"""select s.m, coalesce(c.known, 0) as cur, coalesce(p.known, 0) as prev,
    coalesce(b.n, 0) as both_n, coalesce(a.known, 0) as new_n, coalesce(c.n, 0) as cur_any,
    coalesce(p.n, 0) as prev_any, coalesce(a.n, 0) as new_any
  from spine s
  left join (select m, count(*) as n, count(p) as known from {CUR} group by m) c on c.m = s.m
  left join (select m, count(*) as n, count(p) as known from {PREV} group by m) p on p.m = s.m
  left join (select c.m, count(*) as n from {CUR} c join {PREV} p on p.m = c.m and p.p = c.p
    group by c.m) b on b.m = s.m
  left join (select c.m, count(*) as n, count(c.p) as known from {CUR} c where not exists
    (select 1 from {PREV} p where p.m = c.m and p.p = c.p) group by c.m) a on a.m = s.m"""


def entity_family(s: Scope) -> list[str]:
    odd = bad(f"{pct('both_n', 'prev')} < 50 or {pct('new_n', 'cur')} > 50", "WARN")
    t = "temporal"
    rows = [
        row(t, "patient_overlap", "overlap_percentage", "both_n", "prev", pct("both_n", "prev"), odd),
        row(t, "patient_overlap", "new_patients_percentage", "new_n", "cur", pct("new_n", "cur"),
            odd),
        row(t, "new_patients", "new_patients_percentage", "new_any", "cur_any",
            pct("new_any", "cur_any"), bad(f"{pct('new_any', 'cur_any')} > 50", "WARN")),
        row(t, "patient_retention", "retention_rate", "both_n", "prev_any",
            pct("both_n", "prev_any"), bad(f"{pct('both_n', 'prev_any')} < 50", "WARN")),
        row(t, "patient_count", "current_month", "cur", "null", "cur"),
        row(t, "patient_count", "previous_month", "prev", "null", "prev",
            keep="cur > 0 and prev = 0")]
    for check, name, a, b in (("overlapping_patients", "overlap", "both_n", "prev"),
                              ("appearing_patients", "new", "new_n", "cur"),
                              ("returning_patients", "returning", "both_n", "prev")):
        keep = "cur > 0 and prev > 0"
        rows.append(row(t, check, f"{name}_count", a, b, a, keep=keep))
        rows.append(row(t, check, f"{name}_percentage", a, b, pct(a, b), keep=keep))
    return [block(_entities(), rows)]


def code_changes() -> str:
    counts = ("select m, ndc11 as k, count(distinct patient_id) as c, count(ndc11) as nn from em "
              "group by m, ndc11")
    cur = f"select m, k, c from ({counts}) where nn > 0"
    prev = f"select cast(m + interval 1 month as date) as m, k, c from ({counts}) where nn > 0"
    return (f"select s.m, x.k, x.cur, x.prev, {chg('x.cur', 'x.prev')} as change_pct from spine s "
            f"join (select coalesce(a.m, b.m) as m, coalesce(a.k, b.k) as k, coalesce(a.c, 0) as "
            f"cur, coalesce(b.c, 0) as prev from ({cur}) a full outer join ({prev}) b "
            f"on a.m = b.m and a.k = b.k) x on x.m = s.m")


def _shifts(condition: str, check: str) -> str:
    wide = spined(f"select m, count(*) as x from ({code_changes()}) where abs(change_pct) > 50 and "
                  f"{condition} group by m", ["x"])
    return block(wide, [row("temporal", check, "significant_changes_count", "x",
                            "null", "x", bad("x > 0", "WARN"))])


def shifts(s: Scope) -> list[str]:
    return [_shifts("cur >= 10", "medication_changes")]


def shifts_v4(s: Scope) -> list[str]:
    return [_shifts("cur > 10", "medication_changes_by_count")]


# -- volume ---------------------------------------------------------------

CHECKS = {
    "code": ("code_count", "current_count_codes", None, "change_percentage"),
    "provider": ("provider_metrics", "current_provider_count", "current_patients_with_provider",
                 "provider_count_change_percentage"),
    "organization": ("organization_metrics", "current_org_count", "current_patients_with_org",
                     "org_count_change_percentage"),
    "payer": ("payer_metrics", "current_payer_count", "current_patients_with_payer",
              "payer_count_change_percentage"),
    "cohort": ("cohort_metrics", "current_cohort_count", "current_patients_with_cohort",
               "cohort_count_change_percentage"),
}


def _two_months(per_month: str, columns: list[str]) -> str:
    """Per-month counts beside those of the month before."""
    both = ", ".join(f"coalesce(c.{x}, 0) as {x}, coalesce(p.{x}, 0) as {x}_p" for x in columns)
    return (f"select s.m, {both} from spine s left join ({per_month}) c on c.m = s.m left join "
            f"({per_month}) p on p.m = cast(s.m - interval 1 month as date)")


def _moved(check, metric, a, threshold):
    b = f"{a}_p"
    value = chg(a, b)
    status = (f"case when {b} = 0 then 'INFO' when abs({value} / 100) <= {threshold} then 'PASS' "
              f"else 'WARN' end")
    return row("volume", check, metric, a, b, value, status)


def volume_totals(s: Scope) -> list[str]:
    roles = s.table["roles"]
    cols = {"n": "count(*)", "p": "count(distinct patient_id)"}
    for r, c in roles.items():
        cols[f"d_{r}"] = f"count(distinct {c})"
        cols[f"w_{r}"] = f"count(distinct case when {c} is not null then patient_id end)"
    per_month = "select m, " + ", ".join(f"{e} as {n}" for n, e in cols.items()) + \
        " from em group by m"
    v = "volume"
    rows = [row(v, "record_count", "current_count_rows", "n", "n_p", "n"),
            _moved("record_count", "change_percentage", "n", 0.5),
            row(v, "patient_count", "current_count_patients", "p", "p_p", "p"),
            _moved("patient_count", "change_percentage", "p", 0.3),
            row(v, "data_loading", "source_data", status="'WARN'", keep="n = 0 and n_p = 0")]
    for r in roles:
        check, count, with_role, change = CHECKS[r]
        rows += [row(v, check, count, f"d_{r}", f"d_{r}_p", f"d_{r}"),
                 _moved(check, change, f"d_{r}", 0.3)]
        if with_role:
            rows.append(row(v, check, with_role, f"w_{r}", f"w_{r}_p", f"w_{r}"))
        if r == "cohort":
            rows.append(_moved(check, "patients_with_cohort_change_percentage", "w_cohort", 0.3))
    for r in CHECKS:
        if r not in roles:
            rows.append(row(v, CHECKS[r][0], "status"))
    return [block(_two_months(per_month, list(cols)), rows)]


def volume_counts(s: Scope) -> list[str]:
    roles = s.table["roles"]
    cols = {"n": "count(*)", "p": "count(distinct patient_id)"}
    rows = [row("volume", "volume_counts", "record_count", "n", "null", "n"),
            row("volume", "volume_counts", "distinct_patient_count", "p", "null", "p")]
    for r, c in roles.items():
        cols[f"d_{r}"] = f"count(distinct {c})"
        rows.append(row("volume", "volume_counts", f"distinct_{r}_count", f"d_{r}", "null",
                        f"d_{r}"))
        if r != "code":
            cols[f"w_{r}"] = f"count(distinct case when {c} is not null then patient_id end)"
            rows.append(row("volume", "volume_counts", f"patients_with_{r}", f"w_{r}", "null",
                            f"w_{r}"))
    per_month = "select m, " + ", ".join(f"{e} as {n}" for n, e in cols.items()) + \
        " from em group by m"
    return [block(spined(per_month, list(cols)), rows)]


def per_id(s: Scope, role: str) -> str:
    c = s.table["roles"][role]
    return (f"select m, {c} as k, count(distinct patient_id) as p from em where {c} is not null "
            f"group by m, {c}")


def averages(s: Scope) -> list[str]:
    out = []
    for r in ("provider", "organization"):
        inner = f"select m, count(*) as k, cast(sum(p) as bigint) as t from ({per_id(s, r)}) group by m"
        a = "(case when k > 0 then cast(t as double) / k else 0.0 end)"
        b = "(case when k_p > 0 then cast(t_p as double) / k_p else 0.0 end)"
        moved = f"(case when {b} > 0 then ({a} - {b}) / {b} * 100 end)"
        check = CHECKS[r][0]
        out.append(block(_two_months(inner, ["k", "t"]), [
            row("volume", check, "avg_patients", "t", "k", f"round({a}, 2)"),
            row("volume", check, "avg_patients_change_percentage", "null", "null", moved,
                f"case when {moved} is null then 'INFO' when abs({moved} / 100) <= 0.3 then "
                f"'PASS' else 'WARN' end")]))
    return out


def top_ids(s: Scope, role: str, k: int = 100) -> str:
    """Top ids of a month with their count in the month before."""
    ids = per_id(s, role)
    return (f"select c.m, '{role}' as role, c.k, c.p, coalesce(q.p, 0) as q from (select *, "
            f"row_number() over (partition by m order by p desc, k) as rn from ({ids})) c left "
            f"join ({ids}) q on q.k = c.k and q.m = cast(c.m - interval 1 month as date) "
            f"join spine s on s.m = c.m where c.rn <= {k}")


def top_id_metrics(s: Scope) -> list[str]:
    return [block(top_ids(s, r), [row("volume", f"{r}_patient_distribution",
                                      f"(concat('{r}: ', k))", "p", "q", "p")])
            for r in ("provider", "organization", "cohort") if r in s.table["roles"]]


def cohort_changes(s: Scope) -> str:
    ids = per_id(s, "cohort")
    return (f"select s.m, x.k, x.a, x.b, x.ap, x.bp from spine s join (select coalesce(c.m, q.m) "
            f"as m, coalesce(c.k, q.k) as k, c.p as a, q.p as b, c.k as ap, q.k as bp from "
            f"({ids}) c full outer join (select cast(m + interval 1 month as date) as m, k, p "
            f"from ({ids})) q on q.m = c.m and q.k = c.k) x on x.m = s.m")


def _kinds(s: Scope) -> str:
    return spined(
        f"select m, count(bp) as np, count(ap) as nc, count(*) filter (where bp is null) as nw, "
        f"count(*) filter (where ap is null) as ms, count(*) filter (where ap is not null and "
        f"b > 0 and abs({chg('a', 'b')}) >= 20) as ch from ({cohort_changes(s)}) group by m",
        ["np", "nc", "nw", "ms", "ch"])


def cohort_shifts(s: Scope) -> list[str]:
    total = "ch + nw + ms"
    return [block(_kinds(s), [row("volume", "cohort_metrics", "cohort_distribution_changes", total,
                                  "null", total, "'WARN'", f"np > 0 and {total} > 0")])]


def cohort_shifts_v4(s: Scope) -> list[str]:
    def word(x):
        return f"case when {x} > 2 then 'WARN' else 'INFO' end"
    some = "np > 0 and nc > 0"
    return [block(_kinds(s), [
        row("volume", "cohort_shifts", "significant_changes", "ch", "null", "ch",
            keep=f"{some} and ch > 0"),
        row("volume", "cohort_changes", "new_cohorts", "nw", "null", "nw", word("nw"),
            f"{some} and nw > 0"),
        row("volume", "cohort_changes", "missing_cohorts", "ms", "null", "ms", word("ms"),
            f"{some} and ms > 0")])]


def cohort_summary(s: Scope) -> list[str]:
    wide = spined(f"select m, least(count(*), 5) as x from ({per_id(s, 'cohort')}) group by m",
                  ["x"])
    return [block(wide, [row("volume", "cohort_patient_distribution", "top_cohorts", "x",
                             keep="x > 0")])]


# -- whole runs -----------------------------------------------------------

FAMILIES = {
    "completeness": [completeness],
    "uniqueness": [uniqueness],
    "validity": [validity],
    "consistency": [date_order, missing_entities, outside_enrollment, outside_events, deaths,
                    providers_by_column, providers_pooled, stability],
    "distribution": [gender, age, event_demo, distribution_tops],
    "temporal": [entity_family, shifts, shifts_v4],
    "volume": [volume_totals, averages, top_id_metrics],
}
COHORT_PARTS = [cohort_summary, cohort_shifts, cohort_shifts_v4]


def suite_body(s: Scope, families=tuple(FAMILIES)) -> str:
    parts = [p for f in families for make in FAMILIES[f] for p in make(s)]
    if "volume" in families and "cohort" in s.table["roles"]:
        parts += [p for make in COHORT_PARTS for p in make(s)]
    return " union all ".join(f"select * from {p}" for p in parts)


# -- checks of one's own -----------------------------------------------------

def custom_checks(s: Scope) -> str:
    """The own checks that the entry registers, over all blocks."""
    shares = {"patient_id_null_percentage": "patient_id is null",
              "procedure_code_null_percentage": "procedure_code is null",
              "late_service_percent": "service_date > kh_refresh_date",
              "no_units_percent": "units <= 0",
              "unit_type_allowed_percent": "upper(unit_type) not in ('UN', 'ML')"}
    names = {"late_service_percent": ("late_service", "WARN", 0),
             "no_units_percent": ("no_units", "WARN", 0),
             "unit_type_allowed_percent": ("unit_type_allowed", "FAIL", 0)}
    counts = ", ".join(f"count(*) filter (where {c}) as a{k}" for k, c in enumerate(shares.values()))
    rows = []
    for k, metric in enumerate(shares):
        check, word, limit = names.get(metric, ("null_percent", "WARN", 5))
        value = pct(f"a{k}", "n")
        rows.append(row("custom", check, metric, f"a{k}", "n", value, bad(f"{value} > {limit}", word)))
    known = "exists (select 1 from providers_m d where d.npi = i.id)"
    inside = ("exists (select 1 from patient_enroll_m d where d.patient_id = e.patient_id and "
              "e.service_date between d.start_date and d.end_date)")
    outside = pct("x", "n")
    moved = chg("c", "p")
    parts = [
        block(f"select m, count(*) as n, {counts} from ev group by m", rows),
        block(f"select m, count(*) as n, count(*) filter (where not {known}) as x from (select "
              "distinct m, billing_npi as id from ev where billing_npi is not null) i group by m",
              [row("custom", "billing_npi_in_providers", "missing_percent", "x", "n", outside,
                   bad(f"{outside} > 0", "WARN"))]),
        block(f"select m, count(*) as n, count(*) filter (where not {inside}) as x from ev e "
              "group by m",
              [row("custom", "outside_enroll", "outside_percent", "x", "n", outside,
                   bad(f"{outside} > 0", "WARN"))]),
        "(select m, 'custom' as check_category, 'cohort_id_top' as check_name, k as metric_name, "
        "n as num, cast(null as bigint) as den, round(cast(n as double) / t * 100, 4) as value, "
        "'INFO' as status from (select m, cohort_id as k, count(*) as n, "
        "sum(count(*)) over (partition by m) as t from ev where cohort_id is not null "
        "group by m, cohort_id qualify row_number() over (partition by m order by n desc, k) <= 3))",
        block(f"select s.m, count(*) filter (where e.m = s.m and units > 1) as c, count(*) filter "
              "(where e.m = s.m - interval 1 month and units > 1) as p from em e, spine s group by "
              "s.m", [row("custom", "several_units", "change_percentage", "c", "p", moved,
                          f"case when p = 0 then 'INFO' when abs({moved}) / 100 <= 0.3 then 'PASS' "
                          "else 'WARN' end")]),
    ]
    return " union all ".join(f"select * from {p}" for p in parts)


def metrics(s: Scope, makers, where: str = "") -> str:
    """A query's metric rows; by month in a range."""
    body = " union all ".join(f"select * from {p}" for make in makers for p in make(s))
    by = "strftime(m, '%Y-%m') as refresh_month, " if s.kind == "range" else ""
    clause = f" where {where}" if where else ""
    return (s.ctes(body) + f"select {by}check_name, metric_name, num, den, value, status "
            f"from ({body}){clause}")
