import numpy as np
import pyarrow as pa

from fundtide.llm import quality_rules, textops


def test_the_field_is_fitted_on_every_labelled_document(llm_spark):
    # More documents of one label than a sample of 1,500 per class would take.
    good = "A plain sentence of content words that ends well.\nAnother line of the same plain text here."
    poor = "MENU | HOME | LOGIN $$$\n### CLICK HERE ### !!!"
    rows = [(i, "\n".join([good] * (1 + i % 3)) + " word" * (i % 17) if i % 7 else poor + f" {i}", int(i % 7 != 0))
            for i in range(1, 2401)]
    rows += [(i, f"{poor} {i}\n{poor}", 0) for i in range(3001, 3051)]
    docs = llm_spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = llm_spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, quality int")

    got = quality_rules.fit_field(docs, labels)

    parts = []
    for _, text, y in sorted(rows):
        found = quality_rules.measure(*textops.utf8(pa.array([text], pa.string())))
        parts.append((y, found.lines))
    x = np.concatenate([x for _, x in parts])
    lengths = np.array([len(x) for _, x in parts])
    y = np.array([y for y, _ in parts])
    lines = np.array([lengths[y == k].sum() for k in (0, 1)])
    weights = lines.sum() / lines * np.array([quality_rules.BOILERPLATE_WEIGHT, 1.0])
    want = quality_rules.LineField.fit(x, lengths, np.repeat(y, lengths), weights[y])
    assert np.allclose(got.emission, want.emission, atol=1e-6)
    assert np.allclose(got.transition, want.transition, atol=1e-6)

