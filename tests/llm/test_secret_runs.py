from kestrel.llm.queries import op8_secret_entropy


def test_keys_of_letters_only(spark, docs_of, written):
    letters = "QzXwVkRtYpLmNbHsGdFcJa"
    texts = {f"é {letters} x": letters, f"path/{letters}": letters, letters: letters}
    quiet = ["internationalization/of_things-and=words", "Donaudampfschifffahrtsgesellschaft",
             f"example/{letters}", "k" * 40, letters[:19], "/usr/share/lib/data/of/the/year"]
    rows = [(k, t, "s") for k, t in enumerate([*texts, *quiet])]
    got = {r.doc_id: [s.split(":") for s in r.spans.split(",") if s.startswith("entropy")]
           for r in op8_secret_entropy(spark, written(documents=docs_of(rows))).collect()}
    for k, (text, secret) in enumerate(texts.items()):
        (_, start, end), = got[k]
        at = text.index(secret)
        assert (int(start), int(end)) == (at, at + len(secret)), text
    for k, text in enumerate(quiet, len(texts)):
        assert not got[k], text
