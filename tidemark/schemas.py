"""Schemas, each a fresh object: ``StructType.add`` changes the one it is called on."""

from __future__ import annotations

from pyspark.sql import types as T


def landing_orders() -> T.StructType:
    """Orders as they arrive in landing-zone files."""
    return T.StructType(
        [
            T.StructField("order_id", T.IntegerType()),
            T.StructField("emp_id", T.IntegerType()),
            T.StructField("product", T.StringType()),
            T.StructField("category", T.StringType()),
            T.StructField("amount", T.DoubleType()),
            T.StructField("order_date", T.DateType()),
            T.StructField("region", T.StringType()),
        ]
    )


def staff() -> T.StructType:
    """Employees, the parent of the landing orders."""
    return T.StructType(
        [
            T.StructField("emp_id", T.IntegerType()),
            T.StructField("name", T.StringType()),
            T.StructField("department", T.StringType()),
            T.StructField("salary", T.DoubleType()),
            T.StructField("hire_date", T.DateType()),
            T.StructField("manager_id", T.IntegerType()),
        ]
    )


def customer_dimension() -> T.StructType:
    """A type 2 dimension."""
    return T.StructType(
        [
            T.StructField("cust_id", T.IntegerType()),
            T.StructField("name", T.StringType()),
            T.StructField("tier", T.StringType()),
            T.StructField("effective_start", T.DateType()),
            T.StructField("effective_end", T.DateType()),
            T.StructField("is_current", T.BooleanType()),
        ]
    )


def customer_orders() -> T.StructType:
    """Order facts of the customer dimension."""
    return T.StructType(
        [
            T.StructField("order_id", T.IntegerType()),
            T.StructField("cust_id", T.IntegerType()),
            T.StructField("amount", T.DoubleType()),
            T.StructField("order_date", T.DateType()),
        ]
    )
