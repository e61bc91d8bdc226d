"""Inputs: warehouse tables, their rendering as source messages, streams and JDBC."""
