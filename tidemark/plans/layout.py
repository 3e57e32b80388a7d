"""Where the tables of one installation live. Any Hadoop path will do as root."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    root: str
    buckets: int = 64
    """Of the keyed Silver table; fixed once it has rows. A bucket should be some gigabytes at most."""

    def _at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def bronze(self, entity: str) -> str:
        return self._at("bronze", f"{entity}_cdc")

    def quarantine(self, entity: str) -> str:
        return self._at("bronze", f"{entity}_rejected")

    @property
    def transactions(self) -> str:
        """Upsert state of the transactions that batches brought, before they are merged."""
        return self._at("silver", "transactions")

    @property
    def transaction_rows(self) -> str:
        """Current transactions, one typed row per key, in buckets: all merged batches."""
        return self._at("silver", "transaction_rows")

    @property
    def transaction_keys(self) -> str:
        """Filters of the keys in :attr:`transaction_rows`, in the same buckets."""
        return self._at("silver", "transaction_keys")

    @property
    def inserts(self) -> str:
        """Each transaction as first inserted, in batches; ``is_late`` parts off those that came
        after the windows they belong to were closed."""
        return self._at("silver", "transaction_inserts")

    @property
    def insert_clock(self) -> str:
        """The latest transaction time in the insert log, after each batch."""
        return self._at("silver", "transaction_insert_clock")

    def violations(self, entity: str) -> str:
        """Bronze rows that break a source constraint."""
        return self._at("quality", f"{entity}_violations")

    @property
    def customers(self) -> str:
        """Customer events with the time of the following one, in batches. In each batch
        ``is_last`` tells the last events of the customers it touched from the closed ones."""
        return self._at("silver", "customers")

    @property
    def customer_reopened(self) -> str:
        """Customers whose closed events a batch replaces, in the batches that do so."""
        return self._at("silver", "customers_reopened")

    @property
    def metrics(self) -> str:
        return self._at("gold", "transaction_metrics")

    @property
    def alerts(self) -> str:
        return self._at("gold", "aml_alerts")

    @property
    def repeated_payments(self) -> str:
        return self._at("gold", "repeated_payments")

    @property
    def batch_log(self) -> str:
        """What each micro-batch of every query has read and observed."""
        return self._at("monitoring", "batch_log")

    def checkpoint(self, query: str) -> str:
        return self._at("checkpoints", query)
