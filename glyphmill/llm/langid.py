"""Language ID with a byte convolutional network, trained here in numpy.

Bytes are embedded, filters of two to four bytes slide over windows of fixed length, each filter's
largest answer in the window goes through a rectifier into a softmax. The probabilities of
all windows of a text are averaged, so the whole text is judged and its length does not matter.

Only training sees labels, on a sample bounded by ``per_lang`` documents of each language and
``cuts`` passages of each. The sample is drawn by a hash of the id against the counted rows of the
language. The model is some 10,000 numbers and goes to the tasks in the function's closure.

Results for odd input: null texts and texts without a letter are ``und`` with score 0; if there
is nothing to learn from, every text is ``und``; ties go to the first language in sort order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphmill.llm.shared import bounded_batches

UNDETERMINED = "und"
WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 8
EMBEDDING = 8
#: Languages that are learnt at most.
MOST_LANGS = 256
_LETTER = regex.compile(r"\p{L}")
_BLOCK = 256  # windows judged at a time


@dataclass
class ByteNetwork:
    langs: list[str]
    embedding: np.ndarray  # 256 x EMBEDDING
    filters: list[np.ndarray]  # by width: width x EMBEDDING x FILTERS
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def tables(self) -> list[np.ndarray]:
        """By width: what a byte at each place of a filter adds to its answer."""
        return [np.einsum("be,oef->obf", self.embedding, w) for w in self.filters]


def windows_of(text: bytes) -> np.ndarray:
    """The bytes in rows of ``WINDOW``; a rest shorter than half a window is padded by the start of the text."""
    data = np.frombuffer(text, np.uint8)
    if len(data) < WINDOW:
        data = np.resize(data, WINDOW)
    n = -(-len(data) // WINDOW)
    if n * WINDOW > len(data):  # the last window ends with the text
        data = np.concatenate((data[: (n - 1) * WINDOW], data[-WINDOW:]))
    return data.reshape(n, WINDOW)


def _answers(x: np.ndarray, tables: list[np.ndarray]) -> list[np.ndarray]:
    out = []
    for width, table in zip(WIDTHS, tables):
        span = WINDOW - width + 1
        answer = table[0][x[:, :span]]
        for o in range(1, width):
            answer += table[o][x[:, o : o + span]]
        out.append(answer)
    return out


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def train(passages: list[bytes], langs: list[str], epochs: int = 6, seed: int = 7) -> ByteNetwork:
    """Adam on cross entropy; the pooled filters alone pass gradients back."""
    names = sorted(set(langs))
    x = np.concatenate([windows_of(p) for p in passages])
    y = np.concatenate([np.full(len(windows_of(p)), names.index(g)) for p, g in zip(passages, langs)])
    rng = np.random.default_rng(seed)
    model = ByteNetwork(
        names,
        rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
        [rng.normal(0, 0.3, (w, EMBEDDING, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(len(WIDTHS) * FILTERS, np.float32),
        rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(names))).astype(np.float32),
        np.zeros(len(names), np.float32),
    )
    weights = [model.embedding, *model.filters, model.bias, model.dense, model.dense_bias]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    share = np.bincount(y, minlength=len(names)).astype(np.float32)
    balance = (len(y) / (len(names) * np.maximum(share, 1)))[y].astype(np.float32)
    steps = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 64):
            rows = order[at : at + 64]
            xb, yb = x[rows], y[rows]
            answers = _answers(xb, model.tables())
            places = [a.argmax(1) for a in answers]
            pooled = np.concatenate([np.take_along_axis(a, p[:, None], 1)[:, 0] for a, p in zip(answers, places)], 1)
            hidden = np.maximum(pooled + model.bias, 0)
            error = _softmax(hidden @ model.dense + model.dense_bias)
            error[np.arange(len(yb)), yb] -= 1
            error *= balance[rows, None] / len(yb)
            back = (error @ model.dense.T) * (hidden > 0)
            d_embedding = np.zeros_like(model.embedding)
            d_filters = []
            for k, (width, place) in enumerate(zip(WIDTHS, places)):
                g = back[:, k * FILTERS : (k + 1) * FILTERS]
                d = np.zeros_like(model.filters[k])
                for o in range(width):
                    seen = np.take_along_axis(xb, place + o, 1)  # the byte under the filter
                    d[o] = np.einsum("nfe,nf->ef", model.embedding[seen], g)
                    np.add.at(d_embedding, seen, g[..., None] * model.filters[k][o].T[None])
                d_filters.append(d)
            gradients = [d_embedding, *d_filters, back.sum(0), hidden.T @ error, error.sum(0)]
            steps += 1
            for w, g, (m, v) in zip(weights, gradients, moments):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= 0.005 * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.99**steps)) + 1e-7)
    return model


class Judge:
    """Probabilities of texts; the first two bytes of a filter are looked up as a pair."""

    def __init__(self, model: ByteNetwork) -> None:
        self.model = model
        two, three, four = model.tables()

        def pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
            return (first[:, None] + second[None]).reshape(65536, FILTERS)

        self.heads = np.concatenate([pairs(two[0], two[1]), pairs(three[0], three[1]), pairs(four[0], four[1])], 1)
        self.third, self.tail = three[2], pairs(four[2], four[3])

    def windows(self, x: np.ndarray) -> np.ndarray:
        out = []
        for at in range(0, len(x), _BLOCK):
            b = x[at : at + _BLOCK]
            pair = b[:, :-1].astype(np.int32) * 256 + b[:, 1:]
            answer = self.heads[pair]
            third, fourth = slice(FILTERS, 2 * FILTERS), slice(2 * FILTERS, None)
            pooled = np.empty((len(b), 3 * FILTERS), np.float32)
            pooled[:, :FILTERS] = answer[..., :FILTERS].max(1)
            pooled[:, third] = (answer[:, :-1, third] + self.third[b[:, 2:]]).max(1)
            pooled[:, fourth] = (answer[:, :-2, fourth] + self.tail[pair[:, 2:]]).max(1)
            hidden = np.maximum(pooled + self.model.bias, 0)
            out.append(_softmax(hidden @ self.model.dense + self.model.dense_bias))
        return np.concatenate(out)

    def __call__(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        pending: list[tuple[int, np.ndarray]] = []

        def settle() -> None:
            probabilities = self.windows(np.concatenate([w for _, w in pending]))
            starts = np.cumsum([0] + [len(w) for _, w in pending[:-1]])
            sums = np.add.reduceat(probabilities.astype(np.float64), starts)
            for (i, w), total in zip(pending, sums):
                best = int(total.argmax())
                langs[i], scores[i] = self.model.langs[best], min(1.0, float(total[best]) / len(w))
            pending.clear()

        size = 0
        for i, text in enumerate(texts):
            if text is not None and self.model.langs and _LETTER.search(text):
                pending.append((i, windows_of(text.lower().encode("utf-8", "replace"))))
                size += len(pending[-1][1])
                if size >= 4096:
                    settle()
                    size = 0
        if pending:
            settle()
        return langs, scores


def labelled_sample(
    docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_lang: int, cuts: int, length: int
) -> tuple[list[bytes], list[str]]:
    """Up to ``per_lang`` ids of each of the ``MOST_LANGS`` most frequent languages, ``cuts`` passages of
    ``length`` characters of one row of each: the ids of the least hashes, however often one is repeated."""
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = rows.groupBy(F.col(lang_col).alias("lang")).agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64(F.col(id_col))).alias("ids")
    )
    counts = counts.orderBy(F.desc("n"), "lang").limit(MOST_LANGS).collect()
    if not counts:
        return [], []
    draw = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30)) / (1 << 30)
    # Twice as many as are wanted, so that enough are left whatever the hashes are.
    shares = {r["lang"]: min(1.0, 2.0 * per_lang / r["ids"]) for r in counts}
    share = F.create_map(*[F.lit(x) for g in sorted(shares) for x in (g, shares[g])])
    n = F.length(text_col)
    passages = F.transform(
        F.sequence(F.lit(0), F.lit(cuts - 1)),
        lambda k: F.substr(F.col(text_col), (F.floor(n * k / cuts) + 1).cast("int"), F.lit(length)),
    )
    one_each = (
        rows.filter(draw < F.try_element_at(share, F.col(lang_col)))
        .select(F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col)).alias("place"), passages.alias("passages"))
        .groupBy("lang", "place")
        .agg(F.min("passages").alias("passages"))
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place"))
    drawn = one_each.withColumn("rank", rank).filter(F.col("rank") <= per_lang).orderBy("lang", "place").collect()
    found = [(p.lower().encode("utf-8", "replace"), r.lang) for r in drawn for p in dict.fromkeys(r.passages)]
    found = [x for x in found if x[0].strip()]
    return [p for p, _ in found], [g for _, g in found]


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_lang: int = 400,
    cuts: int = 4,
) -> ByteNetwork | None:
    """A network for the languages of ``docs``; None without a labelled text."""
    bounded_batches(docs.sparkSession)
    passages, langs = labelled_sample(docs, id_col, text_col, lang_col, per_lang, cuts, 2 * WINDOW)
    return train(passages, langs) if passages else None


def predict(text: Column, model: ByteNetwork | None) -> Column:
    """Struct of ``lang`` and ``score`` of a text."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        judge = Judge(model) if model is not None else None
        for texts in batches:
            langs, scores = judge(list(texts)) if judge else ([UNDETERMINED] * len(texts), [0.0] * len(texts))
            yield pd.DataFrame({"lang": langs, "score": scores})

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, "lang string, score double")(text)
