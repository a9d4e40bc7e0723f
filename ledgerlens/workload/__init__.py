"""The warehouse applied to the driver's star-schema tables, with SQL answers to compare against."""
