"""Small hand-typed inputs and helpers shared by the tests."""

import datetime as dt

from tidemark import schemas

# The staff and order rows whose totals the tests know.
STAFF = [
    (1, "Alice Chen", "Engineering", 125000.0, "2019-03-14", None),
    (2, "Bob Okafor", "Engineering", 98000.0, "2020-07-01", 1),
    (3, "Carol Nunez", "Engineering", 101000.0, "2021-01-11", 1),
    (4, "David Kim", "Sales", 72000.0, "2018-05-23", None),
    (5, "Elena Petrova", "Sales", 68000.0, "2022-02-15", 4),
    (6, "Farid Haidari", "Sales", 75000.0, "2021-09-09", 4),
    (7, "Grace Lin", "Marketing", 64000.0, "2020-11-30", None),
    (8, "Hassan Ali", "Marketing", 61000.0, "2022-06-18", 7),
    (9, "Ines Moreau", "Engineering", 133000.0, "2017-08-04", 1),
    (10, "Jamal Smith", "Engineering", 89000.0, "2023-01-09", 1),
    (11, "Katya Ivanova", "Sales", 70000.0, "2019-12-01", 4),
    (12, "Liam O'Brien", "Marketing", 59000.0, "2023-04-22", 7),
    (13, "Mona Farouk", "Engineering", None, "2023-11-01", 1),
    (14, "Noah Bergstrom", "Finance", 88000.0, "2016-06-06", None),
    (15, "Olivia Tran", "Finance", 85000.0, "2021-03-17", 14),
]
ORDERS = [
    (1001, 4, "Widget A", "Hardware", 250.00, "2023-01-05", "West"),
    (1002, 4, "Widget B", "Hardware", 410.50, "2023-01-19", "West"),
    (1003, 5, "Widget A", "Hardware", 250.00, "2023-02-02", "East"),
    (1004, 6, "Gadget X", "Electronics", 899.99, "2023-02-11", "West"),
    (1005, 11, "Widget C", "Hardware", 150.75, "2023-03-01", "North"),
    (1006, 5, "Gadget Y", "Electronics", 1200.00, "2023-03-14", "East"),
    (1007, 4, "Widget A", "Hardware", 250.00, "2023-04-02", "West"),
    (1008, 6, "Widget B", "Hardware", 410.50, "2023-04-19", "West"),
    (1009, 11, "Gadget X", "Electronics", 899.99, "2023-05-05", "North"),
    (1010, 5, "Widget C", "Hardware", 150.75, "2023-05-22", "East"),
    (1011, 4, "Gadget Y", "Electronics", 1200.00, "2023-06-01", "West"),
    (1012, 6, "Widget A", "Hardware", 250.00, "2023-06-10", "West"),
    (1013, 999, "Widget A", "Hardware", 250.00, "2023-06-15", "South"),
    (1014, 11, "Widget B", "Hardware", 410.50, "2023-07-01", "North"),
    (1015, 5, "Gadget X", "Electronics", 899.99, "2023-07-19", "East"),
]
ORDER_HEADER = "order_id,emp_id,product,category,amount,order_date,region"
# The lines of ORDERS above that arrive damaged, as CSV text.
MESSY_LINES = [
    "1001,4,Widget A,Hardware,250.00,2023-01-05,West",
    "1002,4,Widget B,Hardware,410.50,2023-01-19,West",
    "1003,5,Widget A,Hardware,not_a_number,2023-02-02,East",
    "1004,6,Gadget X,Electronics,899.99,2023-02-11,West",
    "1005,11,Widget C,Hardware,150.75,2023-03-01",
    "1006,5,Gadget Y,Electronics,1200.00,2023-03-14,East",
    "1007,4,Widget A,Hardware,250.00,2023-04-02,West,UNEXPECTED_EXTRA_FIELD",
    "1008,6,Widget B,Hardware,410.50,2023-04-19,West",
]


def day(text):
    return dt.date.fromisoformat(text)


def staff(spark):
    return spark.createDataFrame([(*r[:4], day(r[4]), r[5]) for r in STAFF], schemas.staff())


def orders(spark):
    return spark.createDataFrame([(*r[:5], day(r[5]), r[6]) for r in ORDERS], schemas.landing_orders())


def order_line(row):
    return ",".join(str(v) for v in row)


def write_lines(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def write_csv(path, rows=ORDERS, header=ORDER_HEADER):
    return write_lines(path, [header, *(order_line(r) for r in rows)])


def write_staff_csv(path):
    lines = [",".join("" if v is None else str(v) for v in r) for r in STAFF]
    return write_lines(path, ["emp_id,name,department,salary,hire_date,manager_id", *lines])


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def plan_of(df):
    """Physical plan after an action, as text."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
