"""Load streams of JSON messages into typed tables with Spark."""
