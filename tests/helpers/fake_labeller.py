"""A stand-in for a model client: labels by the keyword's last word."""


def label(words):
    table = {"bolt": "Action", "ring": "Romance"}
    return [table.get(w.split(" ")[-1], "Comedy") for w in words]
