"""The eight target tables and the shape of the input documents."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "long": T.LongType(),
}


@dataclass(frozen=True)
class Table:
    """A target table; a column line reads `name type [required]`."""

    name: str
    key: tuple[str, ...]
    layout: str

    @cached_property
    def _lines(self) -> list[list[str]]:
        return [line.split() for line in self.layout.strip().splitlines()]

    @cached_property
    def columns(self) -> list[str]:
        return [words[0] for words in self._lines]

    @cached_property
    def types(self) -> dict[str, T.DataType]:
        return {words[0]: _TYPES[words[1]] for words in self._lines}

    @cached_property
    def required(self) -> list[str]:
        return [words[0] for words in self._lines if words[2:] == ["required"]]

    @cached_property
    def schema(self) -> T.StructType:
        # Parquet reads come back nullable, so "required" is checked explicitly.
        return T.StructType([T.StructField(c, t, True) for c, t in self.types.items()])


# --- Fixed values: target columns, types, required columns and keys ---------

FACT_ORDER_ITEMS = Table(
    "fact_order_items",
    ("selection_guid", "order_guid"),
    """
    selection_guid       string     required
    order_guid           string     required
    check_guid           string     required
    restaurant_guid      string     required
    business_date        date       required
    menu_item_guid       string
    server_guid          string
    menu_item_name       string
    sales_category_name  string
    item_quantity        double
    item_price           double
    pre_discount_price   double
    discount_amount      double
    tax_amount           double
    check_total          double
    check_tax            double
    check_tip            double
    payment_type         string
    is_voided            boolean
    is_deleted           boolean
    _loaded_at           timestamp  required
    """,
)

FACT_CASH_ENTRIES = Table(
    "fact_cash_entries",
    ("cash_entry_guid",),
    """
    cash_entry_guid      string     required
    restaurant_guid      string     required
    business_date        date       required
    employee_guid        string
    entry_type           string
    amount               double
    reason               string
    notes                string
    cash_drawer_guid     string
    entry_date           timestamp
    _loaded_at           timestamp  required
    """,
)

FACT_CASH_DEPOSITS = Table(
    "fact_cash_deposits",
    ("deposit_guid",),
    """
    deposit_guid         string     required
    restaurant_guid      string     required
    business_date        date       required
    deposit_date         timestamp
    deposit_amount       double
    cash_amount          double
    check_amount         double
    _loaded_at           timestamp  required
    """,
)

FACT_LABOR_SHIFTS = Table(
    "fact_labor_shifts",
    ("time_entry_guid",),
    """
    time_entry_guid      string     required
    restaurant_guid      string     required
    business_date        date       required
    employee_guid        string
    job_guid             string
    job_title            string
    in_date              timestamp
    out_date             timestamp
    regular_hours        double
    overtime_hours       double
    hourly_wage          double
    regular_pay          double
    overtime_pay         double
    total_pay            double
    declared_tips        double
    is_deleted           boolean
    _loaded_at           timestamp  required
    """,
)

DIM_RESTAURANTS = Table(
    "dim_restaurants",
    ("restaurant_guid",),
    """
    restaurant_guid      string     required
    restaurant_name      string
    location_name        string
    address_line1        string
    address_line2        string
    city                 string
    state                string
    zip_code             string
    timezone             string
    _loaded_at           timestamp  required
    """,
)

DIM_EMPLOYEES = Table(
    "dim_employees",
    ("employee_guid",),
    """
    employee_guid        string     required
    restaurant_guid      string     required
    first_name           string
    last_name            string
    email                string
    external_id          string
    is_deleted           boolean
    _loaded_at           timestamp  required
    """,
)

DIM_JOBS = Table(
    "dim_jobs",
    ("job_guid",),
    """
    job_guid             string     required
    restaurant_guid      string     required
    job_title            string
    default_wage         double
    tipped               boolean
    is_deleted           boolean
    _loaded_at           timestamp  required
    """,
)

# One row per placement of an item in a menu group, hence no unique key.
DIM_MENU_ITEMS = Table(
    "dim_menu_items",
    (),
    """
    menu_item_guid       string     required
    restaurant_guid      string     required
    menu_name            string
    menu_group_name      string
    item_name            string
    price                double
    sales_category_name  string
    visibility           string
    is_deleted           boolean
    _loaded_at           timestamp  required
    """,
)


# --- Fixed values: order fields that carry a timestamp, and a business day ---
ORDER_TIMESTAMPS = [
    "openedDate", "closedDate", "modifiedDate", "paidDate", "voidDate",
    "deletedDate", "createdDate", "promisedDate", "estimatedFulfillmentDate",
]
ORDER_DATES = ["businessDate", "voidBusinessDate"]

# --- Input documents ---------------------------------------------------------
# Days and timestamps come in several forms and are read as text. `restaurantGuid`
# is a variant because an absent key and a null differ there.

# An order without its checks, for work on whole documents.
ORDER_HEADER_DOC = f"""
    guid string, restaurantGuid variant, businessDate string, voidBusinessDate string,
    {", ".join(f"{name} string" for name in ORDER_TIMESTAMPS)},
    voided boolean, deleted boolean, server struct<guid:string>
"""

ORDER_DOC = f"""
    {ORDER_HEADER_DOC},
    checks array<struct<
        guid:string, totalAmount:double, taxAmount:double,
        payments:array<struct<tipAmount:double, type:string>>,
        selections:array<struct<
            guid:string, voided:boolean, itemGuid:string, item:struct<guid:string>,
            displayName:string, salesCategory:struct<name:string>, quantity:double,
            price:double, preDiscountPrice:double, appliedDiscountAmount:double, tax:double>>>>
"""

CASH_ENTRY_DOC = """
    guid string, businessDate string, date string, entryDate string,
    employee struct<guid:string>, type string, amount double, reason string,
    notes string, cashDrawer struct<guid:string>
"""

CASH_DEPOSIT_DOC = """
    guid string, businessDate string, date string, amount double,
    cashAmount double, checkAmount double
"""

TIME_ENTRY_DOC = """
    guid string, businessDate string, inDate string, outDate string,
    employeeReference struct<guid:string>, employee struct<guid:string>,
    jobReference struct<guid:string,title:string,name:string>,
    job struct<guid:string,title:string,name:string>,
    wage double, hourlyWage double, regularHours double, overtimeHours double,
    regularPay double, nonOvertimeHourlyWages double,
    overtimePay double, overtimeHourlyWages double,
    totalPay double, totalWages double, declaredTips double, cashTips double,
    deleted boolean
"""

RESTAURANT_DOC = """
    general struct<name:string,locationName:string,timeZone:string>,
    location struct<address:struct<addressLine1:string,addressLine2:string,city:string,
        stateCode:string,state:string,zipCode:string,zip:string>>,
    locationName string, timeZone string
"""

EMPLOYEE_DOC = """
    guid string, firstName string, lastName string, email string,
    externalId string, externalEmployeeId string, deleted boolean
"""

JOB_DOC = """
    guid string, title string, name string, defaultWage double,
    tipped boolean, deleted boolean
"""

# --- Tables of the loads themselves, beside the eight ------------------------

#: Units that a backfill has finished: a restaurant in a window of days asked for.
LOAD_UNITS = Table(
    "load_units",
    ("kind", "restaurant_guid", "week_start", "week_end"),
    """
    kind             string     required
    restaurant_guid  string     required
    week_start       date       required
    week_end         date       required
    flattened        long
    loaded           long
    _loaded_at       timestamp  required
    """,
)

#: What a stream has set aside.
REJECTS = Table(
    "rejects",
    ("reject_id",),
    """
    reject_id        string     required
    table_name       string     required
    stage            string     required
    restaurant_guid  string
    reject_reason    string     required
    record           string
    """,
)
