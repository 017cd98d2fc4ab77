"""The package's operators and datasets over the driver's tables, with SQL to check them."""
