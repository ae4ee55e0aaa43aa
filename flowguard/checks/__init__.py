"""Registered queries over the test tables and their SQL oracles (see ``flowguard.catalog``)."""
