"""Whole-lake builds, the fixture views and the registered queries."""
