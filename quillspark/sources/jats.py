"""The body of a structured paper: sections with their text, figures, tables, formulas.  Mixed content needs a tree walk, so this is Python."""

from __future__ import annotations

import copy
import re
from xml.etree import ElementTree as ET

MATHML = "http://www.w3.org/1998/Math/MathML"
MATH = (f"{{{MATHML}}}math", "math")


def clean(text: str | None) -> str:
    return re.sub(r"\s+", " ", text or "").strip()


def texts(e, skip: str = "xref"):
    """Texts of e and below without cross-references."""
    if e.tag == skip:
        return
    if e.text:
        yield e.text
    for child in e:
        yield from texts(child, skip)
        if child.tail:
            yield child.tail


def flat(e) -> str:
    return clean(" ".join(texts(e))) if e is not None else ""


def formula(e, recorded: dict | None) -> tuple[str, str, str]:
    """(latex, status, MathML).  recorded: the converter's outputs by MathML; without it there is no converter."""
    if recorded is None:
        return "", "no-converter", ""
    math = e if e.tag in MATH else next((m for m in (e.find(f".//{t}") for t in MATH) if m is not None), None)
    if math is None:
        return "", "no-mathml", ""
    math = copy.deepcopy(math)
    for x in math.iter():
        x.tag = x.tag.split("}", 1)[-1]
    math.set("xmlns", MATHML)
    source = ET.tostring(math, encoding="unicode")
    if source not in recorded:
        return "", "no-converter", source
    latex = recorded[source]
    if not latex or not latex.strip():
        return "", "empty-output", source
    latex = latex.replace("⁡", "")
    latex = re.sub(r"\{([^{}]+)\}", lambda m: "{" + m[1].replace(" ", "") + "}" if re.fullmatch(r"(?:[A-Za-z]\s)+[A-Za-z]", m[1]) else m[1], latex)
    latex = re.sub(r"\b((?:[A-Za-z]\s){2,}[A-Za-z])\b", lambda m: m[0].replace(" ", ""), latex)
    return latex.strip(), "ok" if math.find(".//mtable") is None else "ok-but-matrix-likely-broken", source


def section(sec, recorded: dict | None) -> str:
    """Paragraphs, lists, formulas and sub-sections; figures and tables are listed apart."""

    def shown(e, mark):
        latex = formula(e, recorded)[0]
        return f"{mark}{latex}{mark}" if latex else "[FORMULA]"

    parts = []
    for child in sec:
        if child.tag == "sec":
            title, text = child.findtext("title", default="").strip(), section(child, recorded)
            if title or text:
                parts.append(f"\n## {title}\n{text}")
        elif child.tag == "p":
            buf = [child.text or ""]
            for c in child:
                if c.tag in ("inline-formula", "disp-formula"):
                    buf.append(shown(c, "$" if c.tag == "inline-formula" else "$$"))
                elif c.tag not in ("xref", "fig", "table-wrap"):
                    buf.append(" ".join(texts(c)))
                buf.append(c.tail or "")
            parts.append(clean(" ".join(b for b in buf if b)))
        elif child.tag == "disp-formula":
            parts.append(shown(child, "$$"))
        elif child.tag == "list":
            parts += [f"  - {flat(li)}" for li in child.iter("list-item")]
    return "\n\n".join(p for p in parts if p)


def href(fig) -> str:
    """The first reference of a graphic."""
    return next((v for g in fig.iter() if g.tag.split("}", 1)[-1] == "graphic" for k, v in g.attrib.items() if k.split("}", 1)[-1] == "href" and v), "")


def body(xml: str | None, recorded: dict | None = None) -> dict | None:
    """sections, figures, tables, formulas, n_formulas, text; a section called References is left out."""
    if xml is None:
        return None
    root = ET.fromstring(xml)
    for e in root.iter():
        if not e.tag.startswith(f"{{{MATHML}}}"):
            e.tag = e.tag.split("}", 1)[-1]
    front = root if root.find("front") is None else root.find("front")
    meta = front if front.find(".//article-meta") is None else front.find(".//article-meta")
    own = root.find("body")
    scope = root if own is None else own
    label = lambda e: e.findtext("label", default="").strip()
    sections = [(s.findtext("title", default="").strip(), s) for s in (() if own is None else own.findall("sec"))]
    sections = [{"title": t, "text": section(s, recorded)} for t, s in sections if t.lower() != "references"]
    figures = [{"label": label(f), "caption": flat(f.find("caption")), "graphic_href": href(f), "image_path": "", "image_url": ""} for f in scope.iter("fig")]
    tables = [{"label": label(t), "caption": flat(t.find("caption")), "text": " | ".join(flat(c) for c in t.iter("td")) or " | ".join(flat(c) for c in t.iter("th"))} for t in scope.iter("table-wrap")]
    formulas = []
    for tag, kind in (("disp-formula", "display"), ("inline-formula", "inline")):
        for f in scope.iter(tag):
            latex, status, source = formula(f, recorded)
            formulas.append({"kind": kind, "label": label(f) if kind == "display" else "", "latex": latex, "status": status, "mathml_input": None if status == "ok" else source})
    title, sub, abstract = flat(meta.find(".//article-title")), meta.find(".//subtitle"), meta.find("abstract")
    sub = clean(sub.text) if sub is not None else ""
    abstract = "\n\n".join(p for p in (flat(p) for p in (() if abstract is None else abstract.iter("p"))) if p)
    parts = [f"# {title}"] * bool(title) + [sub] * bool(sub) + [f"\n## Abstract\n\n{abstract}"] * bool(abstract)
    parts += [f"\n## {s['title']}\n\n{s['text']}" for s in sections]
    parts += [f"\n[{f['label']}] {f['caption']}" for f in figures if f["caption"]]
    parts += [f"\n[{t['label']}] {t['caption']}\n{t['text']}" for t in tables if t["caption"] or t["text"]]
    return {"sections": sections, "figures": figures, "tables": tables, "formulas": formulas, "n_formulas": len(formulas), "text": "\n".join(parts).strip()}
