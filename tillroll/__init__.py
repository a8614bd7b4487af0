"""Retail transaction analytics as Spark DataFrame operators.

``sources`` reads raw sales lines, ``operators`` cleans, classifies and groups
them, ``plans`` holds the reports and the load job, ``functions`` the column
expressions they share.
"""
