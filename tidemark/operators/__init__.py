"""Validation, de-duplication and flagging of the three feeds (silver layer)."""
