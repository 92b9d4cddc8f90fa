"""The trial tables laid out as staging, the registered queries and their SQL counterparts."""
