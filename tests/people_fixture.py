"""A small coherent set of source files: snapshot(t) = snapshot(t-1) + hires - leavers."""

import datetime as dt

from workbooks import write_workbook

from rosterloom.plans import JobConfig
from rosterloom.plans.config import people_flow
from rosterloom.sources import Source

REFERENCE = dt.date(2026, 8, 1)
MONTHS = [dt.date(2026, m, 1) for m in (6, 7, 8)]


def _person(i):
    return {
        "CHAPA": f"{i:06d}",
        "NOME": f"Pessoa {i}",
        "CPF": f"{i * 7919:011d}",
        "DTNASCIMENTO": dt.date(1980, 1, 1) + dt.timedelta(days=i),
        "SEXO": "FM"[i % 2],
        "DIRETORIA": f"Direção {i % 3}",
        "GERENCIA": f"Gerência {i % 5}",
        "CODSECAO": f"CC{100 + i % 7}",
        "FUNCAO": f"Cargo {i % 4}",
        "GESTOR": f"Gestor {i % 5}",
        "CODSITUACAO": "A",
        "DATAADMISSAO": dt.date(2015, 1, 1) + dt.timedelta(days=i * 11),
    }


def _table(rows):
    headers = list(rows[0])
    return [headers, *[[r.get(h) for h in headers] for r in rows]]


def write_sources(folder):
    present = {i: _person(i) for i in range(1, 61)}
    next_id, photos, hires, leavers, movements = 61, [], [], [], []
    for month in MONTHS:
        if month != MONTHS[0]:
            for i in sorted(present)[:2]:
                del present[i]
                leavers.append((i, month + dt.timedelta(days=9), "Pedido"))
            for _ in range(3):
                person = _person(next_id) | {"DATAADMISSAO": month + dt.timedelta(days=4)}
                present[next_id] = person
                hires.append(person)
                next_id += 1
            # hired and gone within the month: in no snapshot
            hires.append(_person(next_id) | {"DATAADMISSAO": month})
            leavers.append((next_id, month + dt.timedelta(days=12), "Pedido"))
            next_id += 1
            moved = present[sorted(present)[3]]
            movements.append(
                {
                    "CHAPA": moved["CHAPA"],
                    "DATA_MOVIMENTACAO": month + dt.timedelta(days=2),
                    "TIPO_MOVIMENTACAO": "Transferência",
                    "SECAO_ANTERIOR": moved["CODSECAO"],
                    "CC_PARA": "CC999",
                }
            )
        photos.append([dict(p) for p in present.values()])

    earlier = [{"COMPETENCIA": m} | p for m, ps in zip(MONTHS[:-1], photos) for p in ps]
    write_workbook(folder / "snapshot" / "Quadro 2026.xlsx", {"Base": _table(earlier)})
    last = [
        {
            "Chapa": p["CHAPA"],
            " Nome ": p["NOME"],
            "CPF": p["CPF"].lstrip("0"),
            "DTNASCIMENTO": f"{p['DTNASCIMENTO']:%d/%m/%Y}",
            "Data de Admissão": f"{p['DATAADMISSAO']:%d/%m/%Y}",
            "CODSECAO": p["CODSECAO"],
            "FUNCAO": p["FUNCAO"],
        }
        for p in photos[-1]
    ]
    last[0]["DTNASCIMENTO"] = "31/02/1990"
    write_workbook(folder / "snapshot" / "Quadro 08-2026.xlsx", {"Base": _table(last)})
    hired = [
        {
            "CHAPA": p["CHAPA"],
            "NOME": p["NOME"],
            "DATAADMISSAO": f"{p['DATAADMISSAO']:%d/%m/%Y}",
            "CODSECAO": None if i % 7 == 0 else p["CODSECAO"],
        }
        for i, p in enumerate(hires)
    ]
    write_workbook(folder / "hires" / "hires.xlsx", {"Base": _table(hired)})
    gone = [
        {"CHAPA": f"{i:06d}", "DATADEMISSAO": d, "TIPODEMISSAO": t, "MOTIVO": "Motivo"}
        for i, d, t in leavers
    ]
    write_workbook(folder / "leavers" / "leavers.xlsx", {"Base": _table(gone)}, shared=True)
    write_workbook(folder / "movements" / "movements.xlsx", {"Base": _table(movements)})
    kinds = {1: "Admitido", 2: "Demitido"}
    contractors = [
        {
            "COMPETENCIA": MONTHS[-1],
            "TIPO": kinds.get(k % 10, "Ativo "),
            "CPF": f"{k * 104729:011d}",
            "NOME": f"Terceiro {k}",
            "FORNECEDOR": f"Fornecedor {k % 3}",
        }
        for k in range(30)
    ]
    write_workbook(folder / "contractors" / "contractors.xlsx", {"Base": _table(contractors)})
    slots = [
        {"PERIODO": dt.date(2026, m, 1), "ID_VAGA": f"V{k:05d}", "CODSECAO": f"CC{k}"}
        for m in range(1, 13)
        for k in range(5)
    ]
    halves = {"1S": _table([s for s in slots if s["PERIODO"].month <= 6])}
    halves["2S"] = _table([s for s in slots if s["PERIODO"].month > 6])
    write_workbook(folder / "budget" / "budget_2026.xlsx", halves)
    return {"hires": len(hires), "leavers": len(leavers)}


def job(folder, flows=None, **settings):
    changes = flows or {}
    flow_configs = {
        name: people_flow(
            name,
            Source(
                f"{folder}/{name}/*.xlsx", format="workbook", sheet="*" if name == "budget" else 0
            ),
            **changes.get(name, {}),
        )
        for name in ("snapshot", "hires", "leavers", "movements", "contractors", "budget")
    }
    return JobConfig(output_path=f"{folder}/out", flows=flow_configs, **settings)
